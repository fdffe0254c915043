"""Latest state per key from a change log, as an aggregate that does not care about order.

State of a key: `head`, the newest change; `body`, the newest change that carries a row image; `first_commit`, the earliest
create. Newest is by (sequence, event id). Each is a maximum or minimum, so folding is associative, commutative and
idempotent: late events, replays and batch boundaries cannot change the result, and partial aggregation runs before the
shuffle. A key-only delete changes the head alone, so the last known values stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def image(schema: StructType | str, op: str = "op", before: str = "before_json", after: str = "after_json") -> Column:
    """The row image that a change carries (of a delete, what stood before), parsed; null if it carries none."""
    text = F.when(F.col(op) == "d", F.col(before)).otherwise(F.col(after))
    return F.when(text.isNotNull(), F.from_json(text, schema))


def state_of(changes: DataFrame, keys: list[str], image_col: Column, op: str = "op", seq: str = "source_sequence", event: str = "event_id", commit: str = "source_commit_ts") -> DataFrame:
    """One state row for each change. Key columns must be columns of changes."""
    img = image_col
    return changes.select(
        *[F.col(f"`{k}`") for k in keys],
        F.struct(F.col(seq).alias("seq"), F.col(event).alias("event_id"), F.col(op).alias("op"), F.col(commit).alias("commit_ts")).alias("head"),
        F.when(img.isNotNull(), F.struct(F.col(seq).alias("seq"), F.col(event).alias("event_id"), img.alias("image"))).alias("body"),
        F.when(F.col(op).isin("c", "r"), F.col(commit)).alias("first_commit"),
    )


def fold(state: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key."""
    return state.groupBy(*keys).agg(*_newest())


def _newest() -> list[Column]:
    return [
        F.max_by("head", F.struct("head.seq", "head.event_id")).alias("head"),
        F.max_by("body", F.when(F.col("body").isNotNull(), F.struct("body.seq", "body.event_id"))).alias("body"),
        F.min("first_commit").alias("first_commit"),
    ]


def merge(state: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    return fold(batch if state is None else state.unionByName(batch), keys)


def before_and_after(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """As `merge`, of the batch's keys alone, and `was`: head, body and first_commit as the state has them (null: nothing)."""
    both = state.withColumn("__new", F.lit(False)).unionByName(batch.withColumn("__new", F.lit(True)))
    was = F.any_value(F.when(~F.col("__new"), F.struct("head", "body", "first_commit")), F.lit(True)).alias("was")
    return both.groupBy(*keys).agg(*_newest(), was, F.bool_or("__new").alias("__new")).where("__new").drop("__new")


def flat(state: DataFrame, keys: list[str], columns: list[str], updated_at: Column | None = None) -> DataFrame:
    """The public table: entity columns and the state's own."""
    return state.select(*public(keys, columns), (F.current_timestamp() if updated_at is None else updated_at).alias("_updated_at"))


def public(keys: list[str], columns: list[str], within: str = "") -> list[Column]:
    """The public columns, but for `_updated_at`, of a state row or of one within a struct (`within`: its name and a dot), whose keys lie beside it."""
    value = lambda c: F.coalesce(F.col(f"{within}body.image.`{c}`"), F.col(f"`{c}`")) if c in keys else F.col(f"{within}body.image.`{c}`")
    return [
        *[value(c).alias(c) for c in columns],
        F.col(f"{within}head.event_id").alias("_event_id"),
        F.col(f"{within}head.op").alias("_op"),
        F.col(f"{within}head.seq").alias("_source_sequence"),
        F.col(f"{within}first_commit").alias("_first_commit_ts"),
        F.col(f"{within}head.commit_ts").alias("_last_commit_ts"),
        (F.col(f"{within}head.op") == "d").alias("_is_deleted"),
    ]


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that sorts last, all columns, by window (for tables without the state layout)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def history(df: DataFrame, keys: list[str], order: list[str], columns: list[str], op: str = "op") -> DataFrame:
    """Each change with the values known after it: a delete takes those of the last change before it that has an image."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.last(F.when(F.col(op) != "d", F.struct(*columns)), ignorenulls=True).over(w)
    return df.withColumn("__last", carried).select(*[c for c in df.columns if c not in columns], *[F.col(f"__last.{c}").alias(c) for c in columns])


def upsert(old: DataFrame | None, new: DataFrame, keys: list[str], keep: list[str] | None = None) -> DataFrame:
    """Rows of `new` replace rows of `old` with equal keys; columns in `keep` stay as they were where a row existed."""
    if old is None:
        return new
    o, n = old.alias("o"), new.alias("n")
    on = None
    for k in keys:
        on = (F.col(f"o.{k}") == F.col(f"n.{k}")) if on is None else on & (F.col(f"o.{k}") == F.col(f"n.{k}"))
    was, comes = F.col(f"o.{keys[0]}").isNotNull(), F.col(f"n.{keys[0]}").isNotNull()
    kept = set(keep or [])
    pick = lambda c: F.when(was & (~comes | F.lit(c in kept)), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
    return o.join(n, on, "full_outer").select(*[pick(c).alias(c) for c in old.columns])
