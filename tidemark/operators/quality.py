"""Reconciliation, lineage and detection scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import selection


def verdict(source: Column, target: Column, skip: Column | bool = False) -> Column:
    """PASS, FAIL, or SKIP where a comparison cannot be meant yet."""
    s = skip if isinstance(skip, Column) else F.lit(skip)
    return F.when(s, "SKIP").when(source.eqNullSafe(target), "PASS").otherwise("FAIL")


def missing_events(audit: DataFrame, bronze: DataFrame) -> DataFrame:
    """Acknowledged events that never arrived."""
    return audit.join(bronze.select("event_id"), "event_id", "left_anti")


def evidence(alerts: DataFrame, sources: dict[str, tuple[str, str]]) -> DataFrame:
    """alert_id, source_table, key_name, entity_key of the evidence of each alert. sources: (source table, key name) of each rule."""
    at = lambda k: F.coalesce(*[F.when(F.col("rule") == rule, F.lit(pair[k])) for rule, pair in sorted(sources.items())])
    return alerts.where(F.col("rule").isin(*sources)).select("alert_id", at(0).alias("source_table"), at(1).alias("key_name"), F.explode("evidence_keys").alias("entity_key"))


def named_keys(bronze: DataFrame, pairs: set[tuple[str, str]]) -> DataFrame:
    """Raw events of these source tables, with key_name and entity_key of each of the named keys that their key has."""
    named = F.array(*[F.when(F.col("source_table") == t, F.struct(F.lit(k).alias("key_name"), F.get_json_object("key_json", f"$.{k}").alias("entity_key"))) for t, k in sorted(pairs)])
    found = bronze.where(F.col("source_table").isin(*{t for t, _ in pairs})).withColumn("__key", F.explode(F.array_compact(named)))
    return found.withColumns({c: F.col(f"__key.{c}") for c in ("key_name", "entity_key")})


def lineage(alerts: DataFrame, bronze: DataFrame, sources: dict[str, tuple[str, str]]) -> DataFrame:
    """Every source change behind each alert: rules map to (source table, key name) in `sources`. Bronze is read once."""
    found = named_keys(bronze, set(sources.values()))
    return evidence(alerts, sources).join(found, ["source_table", "key_name", "entity_key"]).select("alert_id", "event_id", "op", "source_system", "source_table", "source_position", "source_sequence", "source_commit_ts", "kafka_topic", "kafka_partition", "kafka_offset", "entity_key", "after_json")


def scores(alerts: DataFrame, truth: DataFrame) -> DataFrame:
    """Per rule: alerts, true positives, planted cases, caught, precision, recall (3 decimals; null over nothing).

    alerts: rule, evidence_keys. truth: rule, keys. A pair shares evidence if it shares a key of the same rule.
    """
    a = alerts.select("rule", F.col("evidence_keys").alias("keys")).withColumn("id", F.monotonically_increasing_id())
    t = truth.select("rule", F.transform("keys", lambda x: x.cast("string")).alias("keys")).withColumn("id", F.monotonically_increasing_id())
    ax, tx = (d.select("rule", F.explode("keys").alias("key")).distinct() for d in (a, t))
    hit = a.select("id", "rule", F.explode("keys").alias("key")).join(tx, ["rule", "key"], "left_semi").select("rule", "id").distinct().groupBy("rule").agg(F.count("*").alias("true_positives"))
    got = t.select("id", "rule", F.explode("keys").alias("key")).join(ax, ["rule", "key"], "left_semi").select("rule", "id").distinct().groupBy("rule").agg(F.count("*").alias("caught"))
    raised = a.groupBy("rule").agg(F.count("*").alias("alerts"))
    planted = t.groupBy("rule").agg(F.count("*").alias("planted"))
    j = raised.join(planted, "rule", "full_outer").join(hit, "rule", "left").join(got, "rule", "left").na.fill(0)
    return j.select(
        "rule",
        "alerts",
        "true_positives",
        (F.col("alerts") - F.col("true_positives")).alias("false_positives"),
        "planted",
        "caught",
        F.round(F.col("true_positives") / F.nullif(F.col("alerts"), F.lit(0)), 3).alias("precision"),
        F.round(F.col("caught") / F.nullif(F.col("planted"), F.lit(0)), 3).alias("recall"),
    )


def percentiles(df: DataFrame, column: str, points: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Interpolated percentiles, two decimals; null over nothing. By selection of ranks: the column isn't sorted."""
    found = selection.percentiles(df, column, (*points, 1.0))
    return found.select(*[F.round(F.get("values", F.lit(i)), 2).alias(name) for i, name in enumerate([*[f"p{int(p * 100)}" for p in points], "max"])])
