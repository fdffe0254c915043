"""Mixing sources to target weights by systematic sampling.

Sizes are words. Targets share the total of all sizes by weight, no source above `max_repeat` times its own size; what
such a source leaves is shared again by weight among the others until none is above. Within a source every document
expects target / source size copies; the documents are laid in order of size, expected copies are prefix-summed, one
random offset is added, and a document is emitted once for each integer boundary its stretch crosses. The order by size
makes the words taken come near the target even where a few documents hold many of them.

Prefix sums need a rank within the source, and a source may hold a third of all rows: documents are range-partitioned by
(source, size, id, number of the row), numbered within their partition, and shifted by the counts of earlier partitions, a table with one row
for each source and partition. The only work in a single task is on the table of sources.

Nulls, ties, repeats: a null text has size 0; a null source is a source, after all others; every row is a document of its
own, even where ids repeat or are null; documents of size 0 take 0 words and are emitted as often as their source's ratio
says; a source whose documents are all empty has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lean, packed, ship, unpacked, written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
WORD = "[^\\x20\\x09-\\x0D]+"


def offset(seed: int, source: str | None) -> float:
    """The source's random offset in [0, 1), of 20 bits so that sums with ranks stay exact."""
    name = f"{seed}|n" if source is None else f"{seed}|s{source}"
    return int(hashlib.md5(name.encode()).hexdigest()[:5], 16) / 2**20


def word_count(column):
    return F.regexp_count(F.coalesce(column, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target, from rows (source, size). Closed form of the resharing: with sources in order of
    cap / weight, a source is capped if the level that the sources from it on would share reaches its cap."""
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    own = own.select("source", "source_size", w.alias("w"), (F.col("source_size") * max_repeat).alias("cap"))
    ratio = F.col("cap") / F.col("w")
    ahead = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    rest = ahead.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = own.select(
        "*",
        ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest)).alias("level"),
        ratio.alias("ratio"),
    )
    # the common level is that of the first source, in this order, that isn't capped
    free = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "level"))).over(everything)
    target = F.when(F.col("level") >= F.col("ratio"), F.col("cap").cast("double")).otherwise(F.col("w") * free["level"])
    return own.select("source", "source_size", target.alias("target"))


@lean
def _local_ranks(batches):
    """Numbers the rows of a sorted partition within their source."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    seen: dict = {}
    for b in batches:
        codes = b.column("source").dictionary_encode(null_encoding="encode")
        idx, names = codes.indices.to_numpy(zero_copy_only=False), codes.dictionary.to_pylist()
        rank = np.zeros(b.num_rows, dtype=np.int64)
        for k, name in enumerate(names):
            at = np.flatnonzero(idx == k)
            rank[at] = np.arange(1, len(at) + 1) + seen.get(name, 0)
            seen[name] = seen.get(name, 0) + len(at)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(rank)], names=[*b.schema.names, "part", "local_rank"])


def mix(docs: DataFrame, key_cols: tuple[str, ...] = ("doc_id",), source_col: str = "source", text_col: str = "text", weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 7) -> DataFrame:
    """key columns, source, size, source_size, target, copies, taken for every row (copies may be 0)."""
    spark = docs.sparkSession
    ship(spark)
    keys = [f"k{i}" for i in range(len(key_cols))]
    base = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(key_cols, keys)], F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"))
    # words are counted once; the range partitioning reads its input twice. Rows that are equal in all else are told apart by a number that is
    # written down with them, so that a third of all rows can't fall to one task
    base = written(base.withColumn("nth", F.monotonically_increasing_id()), "mix-sizes")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").asc_nulls_last(), "size", *[F.col(k).asc_nulls_last() for k in keys], "nth"]
    laid = base.repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema) + ", part int, local_rank long"
    ranked = written(laid.mapInArrow(_local_ranks, schema), "mix-ranks")
    counts = ranked.groupBy("source", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    targets = source_targets(base, weights, max_repeat)
    u = (F.conv(F.substring(F.md5(F.when(F.col("source").isNull(), F.lit(f"{seed}|n")).otherwise(F.concat(F.lit(f"{seed}|s"), "source"))), 1, 5), 16, 10).cast("long") / F.lit(float(2**20))).alias("u")
    table = shifts.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    table = table.select(F.col("source").alias("s"), F.col("part").alias("p"), "shift", "source_size", "target", u)
    # one row for each source and partition: bounded by their numbers, and Spark checks its size before it broadcasts it
    j = ranked.join(table, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    r = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_repeat)))).otherwise(F.lit(0.0))
    rank = (F.col("local_rank") + F.col("shift")).cast("double")
    copies = (F.floor(r * rank + F.col("u")) - F.floor(r * (rank - 1) + F.col("u"))).cast("long")
    j = j.select(*keys, "source", "size", "source_size", "target", copies.alias("copies"))
    return j.select(*[F.col(k).alias(c) for k, c in zip(keys, key_cols)], "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _hashable(docs: DataFrame) -> list:
    """The columns of docs; those with maps in them, which have no hash, as JSON."""
    return [F.to_json(F.struct(F.col(f"`{f.name}`").alias("v"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The mix itself: each row of docs as often as it is emitted (rows not taken go). Columns may have any name and type."""
    keys = ["key1", "key2"]
    own = [F.col(f"`{c}`").alias(name) for name, c in (("doc", id_col), ("source", source_col), ("text", text_col))]
    marked = docs.select(packed(docs), *own, *[F.xxhash64(F.lit(i), *_hashable(docs)).alias(k) for i, k in enumerate(keys)])
    taken = mix(marked, ("doc", *keys), "source", "text", **options)
    copies = taken.groupBy(*keys).agg(F.sum("copies").cast("int").alias("n")).where("n > 0")
    # rows equal in every column are one row here, with the copies of all of them
    one = marked.select("row", *keys).join(copies, keys).dropDuplicates(keys)
    return unpacked(one.select("row", F.explode(F.expr("sequence(1, n)")).alias("copy")), docs.columns)


def sql(docs: str = "documents", seed: int = 7) -> str:
    """DuckDB SQL for the same rows as mix() with default weights."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM {docs}),
own AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS w, 3 * source_size AS cap FROM own),
levels AS (
  SELECT *, cap / w AS ratio,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
free AS (SELECT arg_min(level, ratio) AS level FROM levels WHERE level < ratio),
targets AS (
  SELECT source, source_size, CASE WHEN levels.level >= ratio THEN CAST(cap AS DOUBLE) ELSE w * free.level END AS target,
    CAST(('0x' || substr(md5(CASE WHEN source IS NULL THEN '{seed}|n' ELSE '{seed}|s' || source END), 1, 5)) AS BIGINT) / 1048576.0::DOUBLE AS u
  FROM levels, free),
ranked AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.u,
    CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS r,
    CAST(row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS LAST) AS DOUBLE) AS rank
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(floor(r * rank + u) - floor(r * (rank - 1) + u) AS BIGINT) * size AS taken FROM ranked"""
