"""What every source gives: change events and refused rows as DataFrames, a new watermark, and a manifest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import identity
from tidemark.types import SCHEMA_VERSION

#: Refused rows.
REJECT = "source_system STRING, position STRING, reason STRING, raw STRING"


@dataclass
class Known:
    """What is to be known of a table's rows after a run: all of it, and, if the run only adds, what it adds and how."""

    rows: DataFrame
    keys: list[str]
    news: DataFrame | None = None
    add: Callable[[DataFrame | None, DataFrame], DataFrame] | None = None


@dataclass
class Capture:
    """events: columns of the wire schema and topic_key. known: by table, what is kept with the watermark. ids: file_name, etag, id of the valid rows of
    each file that was taken, and a row without id for each file."""

    events: DataFrame | None
    watermark: dict[str, Any]
    rejects: DataFrame | None = None
    manifest: DataFrame | None = None
    ids: DataFrame | None = None
    known: dict[str, Known] = field(default_factory=dict)

    @property
    def state(self) -> dict[str, DataFrame]:
        return {table: k.rows for table, k in self.known.items()}


class Source(Protocol):
    name: str

    def capture(self, watermark: dict[str, Any] | None, trace_id: str) -> Capture:
        """Must not change any state: the caller commits the watermark once everything is delivered."""

    def stats(self) -> dict[str, dict[str, Any]]: ...


def to_events(df: DataFrame, system: str, database: str, table: str, key_names: list[str], key_json: Column, op: Column, before: Column, after: Column, position: Column, commit_ts: Column, sequence: Column, trace_id: str, key_prefix: str = "") -> DataFrame:
    """Rows of changes as events of the wire schema. key_prefix: where the key columns are found for the topic key."""
    null = F.lit(None).cast("string")
    source = F.struct(F.lit(system).alias("system"), F.lit(database).alias("database"), F.lit(table).alias("table"), position.alias("position"), F.coalesce(commit_ts, null).alias("commit_ts"), F.coalesce(sequence, null).alias("sequence"))
    return df.select(
        identity.event_id(F.lit(system), F.lit(table), key_json, position).alias("event_id"),
        op.alias("op"),
        key_json.alias("key"),
        before.cast("string").alias("before"),
        after.cast("string").alias("after"),
        source.alias("source"),
        F.date_format(F.current_timestamp(), identity.ISO_MICROS).alias("captured_at"),
        F.lit(trace_id).alias("trace_id"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        identity.payload_hash(before.cast("string"), after.cast("string")).alias("payload_hash"),
        identity.topic_key(F.lit(table), key_names, key_prefix).alias("topic_key"),
    )


def json_text(column: Column) -> Column:
    """The column as a JSON value (null, a quoted string, a number)."""
    whole = F.to_json(F.struct(column.alias("v")))  # {"v":...}
    return F.when(column.isNull(), F.lit("null")).otherwise(F.substring(whole, F.lit(6), F.length(whole) - 6))


def event_json() -> Column:
    """The event columns as the message of a topic, names sorted. Images are JSON already and are set in as objects."""
    images, names = ("key", "before", "after"), ("event_id", "op", "captured_at", "trace_id", "schema_version", "payload_hash")
    values = {n: F.coalesce(F.col(n), F.lit("null")) for n in images} | {n: json_text(F.col(n)) for n in names}
    values["source"] = F.coalesce(F.to_json("source", {"ignoreNullFields": "false"}), F.lit("null"))
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), values[n]) for n in sorted(values)]), F.lit("}"))
