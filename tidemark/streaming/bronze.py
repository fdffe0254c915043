"""Topics to the raw event table: parsed, checked, and stored once for each event id."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import checks
from tidemark.streaming.postings import Postings
from tidemark.streaming.stored_ids import StoredIds
from tidemark.streaming.topic_log import TopicLog
from tidemark.tables import Tables
from tidemark.types import EVENT


def new_rows(batch: DataFrame, have: DataFrame, key: str = "event_id") -> DataFrame:
    """The batch without repeats and without what is there already.

    What is there is first cut down to the keys of the batch by a semi join: a batch that Spark may broadcast then costs a scan
    of one column and no shuffle of all that is stored, and for a larger one it may put a Bloom filter before that shuffle. An anti join alone allows neither.
    """
    known = have.select(key).join(batch.select(key), key, "left_semi")
    return batch.dropDuplicates([key]).join(known, key, "left_anti").select(*batch.columns)


def parsed(messages: DataFrame) -> DataFrame:
    """Bronze columns of each message, and what is wrong with it (empty: nothing), with the message itself if something is."""
    m = messages.withColumn("e", F.from_json("value", EVENT)).withColumn("faults", checks.event_faults("e"))
    s = lambda n: F.col(f"e.source.{n}")
    return m.select(
        "e.event_id", "e.op", s("system").alias("source_system"), s("database").alias("source_database"), s("table").alias("source_table"), s("position").alias("source_position"),
        F.coalesce(s("sequence"), s("position")).alias("source_sequence"), F.try_to_timestamp(s("commit_ts")).alias("source_commit_ts"),
        F.col("e.key").alias("key_json"), F.col("e.before").alias("before_json"), F.col("e.after").alias("after_json"), "e.payload_hash", F.try_to_timestamp(F.col("e.captured_at")).alias("captured_at"), "e.trace_id",
        F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), F.col("timestamp").alias("kafka_ts"), F.current_timestamp().alias("ingested_at"), "faults", F.when(F.size("faults") > 0, F.col("value")).alias("raw"),
    )


def run_bronze(tables: Tables, topics: TopicLog, names: list[str], checkpoint: str, dlq: str | None = None, source: DataFrame | None = None, postings: Postings | None = None):
    """Reads what is new in the topics (or in `source`, a stream of messages) once and stops. Bad messages go to the dead-letter topic. postings: gets the
    keys of each batch."""

    stored = StoredIds(tables, "bronze_change_events")

    def query_id() -> str:
        """Of the stream, as its checkpoint has it: a batch that is repeated has the same number under it."""
        return json.loads(tables.files.read_text(f"{checkpoint}/metadata"))["id"]

    def each(batch: DataFrame, batch_id: int) -> None:
        staged = f"{tables.path('bronze_change_events')}__parsed/{query_id()}-{batch_id}"
        try:
            rows = tables.files_of(parsed(batch), staged)
            good = rows.where("size(faults) = 0").drop("faults", "raw")
            fresh = new_rows(good, stored.known(good, but_batch=batch_id))
            for beside in (stored, postings) if postings else (stored,):
                beside.forget(batch_id)
            tables.append("bronze_change_events", fresh, batch=batch_id)
            for beside in (stored, postings) if postings else (stored,):
                beside.add(batch_id)
            bad = rows.where("size(faults) > 0")
            if dlq and not bad.isEmpty():
                value = F.to_json(F.struct(F.lit("topic").alias("source_system"), F.concat_ws(":", "kafka_topic", "kafka_partition", "kafka_offset").alias("position"), F.array_join("faults", "; ").alias("reason"), "raw"))
                key = F.concat_ws(":", "kafka_topic", "kafka_partition", "kafka_offset")
                topics.append(dlq, bad.select(key.alias("key"), value.alias("value"), F.create_map(F.lit("kind"), F.lit("event")).alias("headers")), ["key"], once=(query_id(), batch_id))
        finally:
            tables.files.delete(staged)

    stream = source if source is not None else topics.stream(names)
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q.lastProgress
