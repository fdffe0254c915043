"""A second layout of latest state: by time slab and owner, kept by the batches that change the state.

Rules look a bounded time around what changed. Rows that lie by slab of their own time, and within it in PARTS parts by a hash of their owner, let
the slabs around a change choose the files to read; the state itself lies by key, and would have to be scanned for that. Where a row was
before a batch is taken from the state, so a source that gives no image before (a polled table) moves its rows all the same.

The order makes a batch that is given again harmless: first what the batch changes is written down (`noted`), then the slabs are merged, then the
state. A repeat adds what it finds to what was noted, so the places that rows left stay known until the next batch begins.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import fold
from tidemark.operators.rules import seconds
from tidemark.streaming.silver import Entity, entity_state
from tidemark.tables import Tables

PARTS = 16


def changes(tables: Tables, bronze: DataFrame, e: Entity) -> DataFrame:
    """was, now: the latest-state row of each key in a batch, before it (null: none) and after it. The state isn't written."""
    name, pk = f"{e.silver_table}__state", e.primary_key
    news = entity_state(bronze, e)
    now = F.struct(*fold.public(pk, e.names)).alias("now")
    if not tables.exists(name):
        after = fold.fold(news, pk).select(now)
        return after.select(F.lit(None).cast(after.schema["now"].dataType).alias("was"), "now")
    both = fold.before_and_after(tables.lookup(name, news, pk), news, pk)
    return both.select(F.when(F.col("was").isNotNull(), F.struct(*fold.public(pk, e.names, "was."))).alias("was"), now)


def noted(tables: Tables, bronze: DataFrame, e: Entity, batch: int | str) -> DataFrame:
    """`changes` of a batch, written down, with those that earlier tries of the same batch found; those of other batches go."""
    root = f"{tables.path(e.silver_table)}__changed"
    found = changes(tables, bronze, e)
    kind = found.schema
    found.write.parquet(f"{root}/batch={batch}-try-{uuid.uuid4().hex}")
    mine = []
    for f in tables.files.names(root):
        if f.startswith(f"batch={batch}-try-"):
            mine.append(f"{root}/{f}")
        else:
            tables.files.delete(f"{root}/{f}")
    return tables.spark.read.schema(kind).parquet(*mine)


def images(changed: DataFrame, *names: str) -> DataFrame:
    """Columns of the rows as they were and as they are."""
    return changed.select(F.explode(F.array_compact(F.array("was", "now"))).alias("r")).select(*[F.col(f"r.`{n}`") for n in names])


@dataclass
class Slabs:
    entity: Entity
    owner: str
    ts: str
    length: int  # seconds
    parts: int = PARTS

    @property
    def name(self) -> str:
        return f"{self.entity.silver_table}__slabs"

    def _part(self, owner: Column) -> Column:
        return F.pmod(F.xxhash64(owner), F.lit(self.parts)).cast("int")

    def merge(self, tables: Tables, changed: DataFrame) -> None:
        """Takes changed rows, as they are written down, from where they were and puts them where they are. Rows without owner or time lie nowhere."""
        both = changed.select(F.explode(F.array(F.struct(F.lit(True).alias("gone"), F.col("was").alias("r")), F.struct(F.lit(False).alias("gone"), F.col("now").alias("r")))).alias("x"))
        rows = both.where("x.r is not null").select(F.col("x.gone").alias("__gone"), "x.r.*").where(F.col(f"`{self.owner}`").isNotNull() & F.col(f"`{self.ts}`").isNotNull())
        rows = rows.withColumn("__slab", F.floor(seconds(F.col(f"`{self.ts}`")) / self.length).cast("long")).withColumn("__part", self._part(F.col(f"`{self.owner}`")))
        place = ["__slab", "__part", *self.entity.primary_key]

        def moved(old: DataFrame | None, new: DataFrame) -> DataFrame:
            here = new.where("not __gone").drop("__gone").dropDuplicates(place)
            return here if old is None else old.join(new.select(*place).distinct(), place, "left_anti").unionByName(here)

        tables.merge(self.name, rows, ["__slab", "__part"], moved)

    def around(self, tables: Tables, moments: DataFrame, reach: int) -> DataFrame:
        """Rows of the owners in moments (owner, ts) that lie `reach` seconds from one of them at most, and some more: of the slabs that these
        times fall into. Only the buckets that have such slabs are read."""
        s = seconds(F.col("ts"))
        slab = F.explode(F.sequence(F.floor((s - reach) / self.length).cast("long"), F.floor((s + reach) / self.length).cast("long")))
        wanted = moments.select(F.col("owner").alias(self.owner), "ts").where(F.col(self.owner).isNotNull() & F.col("ts").isNotNull())
        wanted = wanted.select(F.col(self.owner), slab.alias("__slab")).distinct().withColumn("__part", self._part(F.col(self.owner)))
        return tables.lookup(self.name, wanted, ["__slab", "__part"]).join(wanted, [self.owner, "__slab", "__part"], "left_semi").drop("__slab", "__part")

    def of_owners(self, tables: Tables, owners: DataFrame) -> DataFrame:
        """All rows of the owners in a column of the owner's name: a scan."""
        return tables.read(self.name).join(owners.select(self.owner).distinct(), self.owner, "left_semi").drop("__slab", "__part")
