"""Configuration: sources, their tables, topics and secrets."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import UTC, datetime, timedelta
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.base import Source
from tidemark.streaming.silver import Entity

DEFAULT = Path(__file__).resolve().parent.parent / "conf" / "sources.yml"
Secret = Callable[[str, str], str]


def load(path: Path | str = DEFAULT) -> dict[str, Any]:
    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


def environment(key: str, field: str) -> str:
    """A secret from the environment: MSSQL_CARDS_HOST for (mssql-cards, host)."""
    name = f"{key}_{field}".replace("-", "_").upper()
    if name not in os.environ:
        raise KeyError(f"environment variable {name} is not set")
    return os.environ[name]


def qualified(table: dict[str, Any]) -> str:
    return ".".join(filter(None, (table.get("schema"), table["table"])))


def topics_of(source: dict[str, Any]) -> dict[str, str]:
    """Table, as events name it, to topic."""
    return {qualified(t): t["topic"] for t in source["tables"]}


def all_topics(cfg: dict[str, Any]) -> list[str]:
    return [t for s in cfg["sources"].values() for t in topics_of(s).values()] + list(cfg["kafka"].values())


def entities_of(source: dict[str, Any]) -> list[Entity]:
    return [Entity(qualified(t), t["silver_table"], t["primary_key"], t["silver_schema"]) for t in source["tables"]]


def all_entities(cfg: dict[str, Any]) -> list[Entity]:
    return [e for s in cfg["sources"].values() for e in entities_of(s)]


def broker(secret: Secret = environment) -> dict[str, str]:
    """Client settings: plain, or SASL_SSL where an API key is set."""
    conf = {"bootstrap.servers": secret("kafka", "bootstrap")}
    try:
        user, password = secret("kafka", "api_key"), secret("kafka", "api_secret")
    except KeyError:
        return conf
    return conf | {"security.protocol": "SASL_SSL", "sasl.mechanisms": "PLAIN", "sasl.username": user, "sasl.password": password}


def jdbc(spark: SparkSession, url: str, secret: Secret, key: str, **options: str) -> Callable[[str], DataFrame]:
    """A reader of tables or subqueries, given the driver's jar on the class path. Filters are pushed into the source."""

    def read(table: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, user=secret(key, "user"), password=secret(key, "password"), dbtable=table, **options).load()

    return read


def build_source(spark: SparkSession, cfg: dict[str, Any], name: str, known: Callable[[str], DataFrame | None] = lambda t: None, secret: Secret = environment) -> Source:
    """The source of a configured name. Databases are read through JDBC."""
    from tidemark.sources.change_log import ChangeLogSource, LogTable
    from tidemark.sources.file_drop import FileDropSource
    from tidemark.sources.row_versions import RowVersionSource, VersionedRows

    src = cfg["sources"][name]
    key = src["connection_secret"]
    if src["type"] == "fileshare":
        return FileDropSource(spark, secret(key, "dir"), name, src["share"], lambda: known("cdc_file_manifest"))
    if src["type"] == "sqlserver":
        read = jdbc(spark, f"jdbc:sqlserver://{secret(key, 'host')}:{secret(key, 'port')};databaseName={src['database']};encrypt=false", secret, key)
        one = lambda sql: read(f"({sql}) q").first()[0]
        instance = lambda t: t.replace(".", "_")

        def changes(t: str) -> DataFrame:
            df = read(f"(select sys.fn_cdc_map_lsn_to_time(__$start_lsn) as commit_ts, * from cdc.{instance(t)}_CT) q")
            return df.withColumnRenamed("__$start_lsn", "lsn").withColumnRenamed("__$seqval", "seq").withColumnRenamed("__$operation", "code")

        tables = [LogTable(t["schema"], t["table"], t["primary_key"]) for t in src["tables"]]
        top = lambda: None if (v := one("select sys.fn_cdc_get_max_lsn() as v")) is None else bytes(v)
        low = lambda t: bytes(one(f"select sys.fn_cdc_get_min_lsn('{instance(t)}') as v"))
        return ChangeLogSource(name, src["database"], tables, changes, top, low, read)
    if src["type"] == "db2":
        read = jdbc(spark, f"jdbc:db2://{secret(key, 'host')}:{secret(key, 'port')}/{src['database']}", secret, key)
        tables = [VersionedRows(t["schema"], t["table"], t["primary_key"], t["ts_column"]) for t in src["tables"]]

        def rows(t: str) -> DataFrame:
            ts = next(x.ts_column for x in tables if x.qualified == t)
            return read(f"(select t.*, {ts} from {t} t) q").select(F.col("*"))

        def clock() -> datetime:
            return read("(select current timestamp as v from sysibm.sysdummy1) q").first()[0].replace(tzinfo=UTC)

        return RowVersionSource(name, src["database"], tables, rows, clock, known, src.get("snapshot_every", 3), timedelta(seconds=2))
    raise ValueError(f"unknown source type {src['type']!r}")
