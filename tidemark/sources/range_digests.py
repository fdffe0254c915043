"""Two versions of a large table that differ in few rows: digests of ranges of the key choose the rows that are joined.

A range holds the keys whose hash begins with the same bits, FAN of them to a range of the level above. Its digest is the number of its rows, and of
two hashes of (key, fingerprint), 64 bits each, the exclusive or of all rows, with a sum of 31 bits of the first beside it, which
equal pairs don't take out. Digests don't depend on the order of rows, so they are partial aggregates: of each version a row for each range
and task is shuffled, no row of the table. Level by level only ranges whose digests differ are cut further, until they have some LEAF rows;
rows of both versions in those that are left go on to the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.streaming.topic_log import ensure_checkpoint_dir

#: Bits of a level, levels at most, and rows of a range (of both versions) that isn't cut further.
BITS, DEPTH, LEAF = 10, 6, 512


def _range(keys: list[str], depth: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), 64 - BITS * depth)


def _digests(df: DataFrame, keys: list[str], depth: int, side: str) -> DataFrame:
    h = [F.xxhash64(F.lit(i), *[F.col(f"`{k}`") for k in keys], "fingerprint") for i in (1, 2)]
    at = df.select(_range(keys, depth).alias("range"), h[0].alias("h1"), h[1].alias("h2"))
    digest = F.struct(F.count("*").alias("n"), F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"), F.sum(F.col("h1").bitwiseAND(0x7FFFFFFF)).alias("s"))
    return at.groupBy("range").agg(digest.alias(side))


def _inside(df: DataFrame, keys: list[str], depth: int, ranges: DataFrame) -> DataFrame:
    return df.withColumn("__range", _range(keys, depth)).join(ranges.select(F.col("range").alias("__range")), "__range", "left_semi").drop("__range")


class Ranges:
    """The ranges in which two versions differ. Both have the key columns, in the types of the first, and `fingerprint`."""

    def __init__(self, now: DataFrame, known: DataFrame, keys: list[str]):
        ensure_checkpoint_dir(now.sparkSession)
        self.keys, self.kinds = keys, {k: now.schema[k].dataType for k in keys}
        self.depth, self.ranges = 0, None
        a, b = (self._slim(df) for df in (now, known))
        while self.depth < DEPTH:
            some = [self.of(df) for df in (a, b)]
            self.depth += 1
            both = _digests(some[0], keys, self.depth, "a").join(_digests(some[1], keys, self.depth, "b"), "range", "full_outer").where("not (a <=> b)")
            self.ranges = both.select("range", (F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("rows")).checkpoint()
            ranges, rows = self.ranges.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
            if rows <= LEAF * ranges:
                break

    def _slim(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{k}`").cast(kind).alias(k) for k, kind in self.kinds.items()], "fingerprint")

    def of(self, df: DataFrame) -> DataFrame:
        """The rows of df (which has the key columns) in the ranges that differ."""
        if self.ranges is None:
            return df
        cast = df.withColumns({f"__{k}": F.col(f"`{k}`").cast(kind) for k, kind in self.kinds.items()})
        return _inside(cast, [f"__{k}" for k in self.keys], self.depth, self.ranges).drop(*[f"__{k}" for k in self.keys])
