"""The analyst queue's consumer: alerts of a topic into the store, offsets committed by the checkpoint after it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.service import AlertStore
from tidemark.streaming.topic_log import TopicLog

# Fixed values.
REQUIRED = ("alert_id", "rule", "account_id", "evidence_keys")
COUNTS = ("stored", "duplicate", "rejected")
ALERT = "alert_id STRING, rule STRING, account_id INT, evidence_keys ARRAY<STRING>, first_evidence_ts STRING, last_source_commit_ts STRING, alert_created_at STRING, latency_seconds DOUBLE"


def readable(messages: DataFrame) -> DataFrame:
    """Alert columns and `ok`: whether the message is JSON with every required field."""
    m = messages.withColumn("a", F.from_json("value", ALERT))
    ok = F.lit(True)
    for c in REQUIRED:
        ok = ok & F.col(f"a.{c}").isNotNull()
    return m.select("a.*", F.coalesce(ok, F.lit(False)).alias("ok"))


def consume(store: AlertStore, topics: TopicLog, topic: str, checkpoint: str) -> dict[str, int]:
    """Stores what is new and returns counts of stored, duplicate and rejected messages of this run.

    A batch's counts are written down before its alerts are stored, under its number; if it is given again, they stand, so no message is
    counted twice or, as its alerts are there by then, as a duplicate of itself. `totals` adds up those of all runs.
    """
    mine: dict[int, dict[str, int]] = {}

    def each(batch: DataFrame, number: int) -> None:
        rows = readable(batch).persist()
        try:
            good = rows.where("ok").drop("ok")
            at = f"{checkpoint}/counts/{number}.json"
            if not store.tables.files.exists(at):
                n, n_good = rows.agg(F.count("*"), F.count_if("ok")).first()
                new = store.unknown(good)
                store.tables.files.write_text(at, json.dumps({"stored": new, "duplicate": n_good - new, "rejected": n - n_good}))
            mine[number] = json.loads(store.tables.files.read_text(at))
            store.upsert(good, count=False)
        finally:
            rows.unpersist()

    q = topics.stream([topic]).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return {k: sum(c[k] for c in mine.values()) for k in COUNTS}


def totals(store: AlertStore, checkpoint: str) -> dict[str, int]:
    """Counts of all batches under a checkpoint."""
    files = store.tables.files
    found = [json.loads(files.read_text(f"{checkpoint}/counts/{f}")) for f in files.names(f"{checkpoint}/counts")]
    return {k: sum(c[k] for c in found) for k in COUNTS}
