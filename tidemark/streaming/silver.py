"""Raw events to latest-state tables, one for each entity, by the order-free fold."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import fold
from tidemark.tables import Tables
from tidemark.types import TABLES, schema


@dataclass
class Entity:
    source_table: str
    silver_table: str
    primary_key: list[str]
    columns: str  # DDL

    @property
    def names(self) -> list[str]:
        return schema(self.columns).names


def entity_state(bronze: DataFrame, e: Entity) -> DataFrame:
    """State rows of the entity's changes; keys come from the key JSON, so a key-only delete has them too."""
    s = schema(e.columns)
    key_type = ", ".join(f"`{k}` {s[k].dataType.simpleString()}" for k in e.primary_key)
    mine = bronze.where(F.col("source_table") == e.source_table).withColumn("__k", F.from_json("key_json", key_type))
    mine = mine.select("*", *[F.col(f"__k.{k}").alias(k) for k in e.primary_key])
    return fold.state_of(mine, e.primary_key, fold.image(s))


def apply_batch(tables: Tables, bronze: DataFrame, e: Entity) -> None:
    """Folds a batch into the buckets of the entity's state that its keys are in."""
    tables.merge(f"{e.silver_table}__state", entity_state(bronze, e), e.primary_key, lambda old, batch: fold.merge(old, batch, e.primary_key))


def view(tables: Tables, e: Entity) -> DataFrame:
    """The public latest-state table."""
    from tidemark.types import STATE_META

    name = f"{e.silver_table}__state"
    if not tables.exists(name):
        return tables.spark.createDataFrame([], f"{e.columns}, {STATE_META}")
    return fold.flat(tables.read(name), e.primary_key, e.names)


def run_silver(tables: Tables, entities: list[Entity], checkpoint: str, after: Callable[[DataFrame], None] | None = None, before: Callable[[DataFrame, str], None] | None = None):
    """Folds the raw events that are new since the last run, and stops. `before` gets each batch and a name that it has again if it is given again, `after` the batch
    once its state is stored; both must be done with it when they return. A batch that fails is given again."""

    def each(batch: DataFrame, number: int) -> None:
        query = json.loads(tables.files.read_text(f"{checkpoint}/metadata"))["id"]
        staged = f"{tables.path('bronze_change_events')}__folded/{query}-{number}"
        try:
            rows = tables.files_of(batch, staged)
            if before:
                before(rows, f"{query}-{number}")
            for e in entities:
                apply_batch(tables, rows, e)
            if after:
                after(rows)
        finally:
            tables.files.delete(staged)

    stream = tables.stream("bronze_change_events", TABLES["bronze_change_events"])
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q.lastProgress
