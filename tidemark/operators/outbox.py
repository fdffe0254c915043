"""The outbox: alerts whose published_at is empty are due; those delivered are stamped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
FIELDS = ("alert_id", "rule", "account_id", "evidence_keys", "first_evidence_ts", "last_source_commit_ts", "alert_created_at", "latency_seconds")


def pending(alerts: DataFrame) -> DataFrame:
    return alerts.where("published_at is null")


def stamped(alerts: DataFrame, delivered: DataFrame, at: Column | None = None) -> DataFrame:
    """alerts with published_at set where it was empty and the id was delivered."""
    sent = delivered.select(F.col("alert_id").alias("__sent")).distinct()
    j = alerts.join(sent, F.col("alert_id") == F.col("__sent"), "left")
    now = F.current_timestamp() if at is None else at
    return j.withColumn("published_at", F.coalesce("published_at", F.when(F.col("__sent").isNotNull(), now))).select(*alerts.columns)


def alert_json(alerts: DataFrame) -> Column:
    """The message of an alert: schema version and eight fields, times in ISO form, nulls kept."""
    times = {"first_evidence_ts", "last_source_commit_ts", "alert_created_at"}
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    parts = [(F.date_format(c, iso) if c in times else F.col(c)).alias(c) for c in FIELDS]
    return F.to_json(F.struct(F.lit(1).alias("schema_version"), *parts), {"ignoreNullFields": "false"})
