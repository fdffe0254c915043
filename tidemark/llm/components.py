"""Connected components of a graph given as a table of edges, by alternating large-star and small-star steps.

Before the first step each partition's edges are contracted to a forest of stars, which halves the steps where edges repeat.
Each step is a grouped minimum (with map-side combine) and a join on the node, so a node with very many neighbours is one row
of the grouped side and the join side that Spark may split. The number of rounds grows with the logarithm of the longest
path. Every step's edges are written to the shared folder, which cuts lineage, and are summed while they are written, so
that the end is seen without another pass.

Nulls, ties, repeats: edges with a null end, from a node to itself, or given twice, in either order, change nothing; no edges give
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, lean, release, written

#: Edges that are contracted at a time; bounds the memory of a worker.
FOREST_ROWS = 1 << 20


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of these edges and the smallest node of the component each is in, by pointer jumping."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    lo, hi = np.minimum(at[: len(a)], at[len(a) :]), np.maximum(at[: len(a)], at[len(a) :])
    root = np.arange(len(nodes))
    while len(lo):
        np.minimum.at(root, hi, lo)
        while (root[root] != root).any():
            root = root[root]
        x, y = root[lo], root[hi]
        lo, hi = np.minimum(x, y), np.maximum(x, y)
        open_ = lo != hi
        lo, hi = lo[open_], hi[open_]
    return nodes, nodes[root]


@lean
def _forest(batches):
    held, rows = [], 0

    def stars():
        nodes, root = roots_of(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))
        away = nodes != root
        return pa.RecordBatch.from_arrays([pa.array(nodes[away]), pa.array(root[away])], names=["a", "b"])

    for batch in batches:
        if batch.num_rows:
            held.append(tuple(batch.column(c).to_numpy() for c in ("a", "b")))
            rows += batch.num_rows
        if rows >= FOREST_ROWS:
            yield stars()
            held, rows = [], 0
    if held:
        yield stars()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.min("a")).alias("m"))
    return both.join(least, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    moved = edges.join(least, F.col("a") == F.col("n")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))


def _clean(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _summed(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Written edges, their number and a sum over them."""
    seen = Observation()
    out = written(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")), "cc")
    return out, (seen.get["n"], seen.get["s"])


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component), for every node but the roots. edges: a, b long, in either order."""
    some = edges.where("a is not null and b is not null").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    now, sign = _summed(_clean(some.mapInArrow(_forest, "a long, b long")))
    while sign[0]:
        after, then = _summed(_small_star(_clean(_large_star(now))).distinct())
        dropped(now)
        now, same = after, then == sign
        if same:
            break
        sign = then
    release(now.sparkSession)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
