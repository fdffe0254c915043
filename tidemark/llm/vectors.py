"""Routing of vectors and query blocks for the searches over embeddings.

units() lets every query of a stated set meet every vector once (cells.py sends it to some of them only). Vectors are dealt to shards, as many
as the square root of the rows over SHARD_SCALE and enough that none has more than SHARD_ROWS; queries to slabs of SLAB_BYTES. A task
sorts its (shard, slab) units so that one side comes first, which it holds, and streams the other past it in blocks: of
units() the queries are held (streamed), of cells.py the vectors (searcher). So memory holds a slab or a part of a cell, of bounded bytes
both, and a block; and what a task gives back are k rows for each query, however many vectors have passed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import narrow

SHARD_SCALE = 64
SHARD_ROWS = 1 << 18
SLAB_ROWS = 1 << 16
SLAB_BYTES = 64 << 20
BLOCK_ROWS = 256
STREAM_ROWS = 4096
NONE = float("-inf")


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec of the rows that take part: no null id or vector, no null or non-finite component. Vectors of floats stay so, which
    halves what is sent; matrix() makes doubles of them."""
    v = narrow(vectors, id=id_col, vec=vec_col)
    kind = "array<float>" if v.schema["vec"].dataType.simpleString() == "array<float>" else "array<double>"
    v = v.select(F.col("id").cast("long").alias("id"), F.col("vec").cast(kind).alias("vec"))
    ok = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return v.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & ok)


def units(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """shard, slab, side (0 queries, 1 vectors), tag (of a query's row), id, vec: partitioned and sorted by unit.

    Query rows that are equal are asked once; rows with one id and different vectors are told apart by their tag.
    """
    n_rows, wide = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
    n_asked, wide_asked = queries.agg(F.count("*"), F.max(F.size("vec"))).first()
    shards = max(1, math.ceil(math.sqrt(n_rows / SHARD_SCALE)), -(-n_rows // SHARD_ROWS))
    slabs = max(1, -(-n_asked * 4 * max(wide or 1, wide_asked or 1) // SLAB_BYTES))
    dealt = lambda n: F.pmod(F.xxhash64("id", "vec"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = rows.select(dealt(shards).alias("shard"), every(slabs).alias("slab"), F.lit(1).alias("side"), F.lit(0).cast("long").alias("tag"), "id", "vec")
    asked = tagged(queries).select(every(shards).alias("shard"), dealt(slabs).alias("slab"), F.lit(0).alias("side"), "tag", "id", "vec")
    return sent(base.unionByName(asked), shards * slabs)


def tagged(queries: DataFrame) -> DataFrame:
    """Different query rows, with a tag that tells those of one id apart."""
    return queries.dropDuplicates(["id", "vec"]).withColumn("tag", F.xxhash64("id", "vec"))


def sent(both: DataFrame, n_units: int) -> DataFrame:
    """Rows and queries partitioned and sorted by unit, what a task holds first."""
    parts = max(n_units, int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return both.repartition(parts, "shard", "slab").sortWithinPartitions("shard", "slab", "side", "id")


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows as a dense matrix, short ones filled up with 0, and their lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width), sizes
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, at] = flat
    return out, sizes


def fit(m: np.ndarray, width: int) -> np.ndarray:
    """The matrix with so many columns (cut, or filled up with 0)."""
    if m.shape[1] >= width:
        return m[:, :width]
    return np.hstack((m, np.zeros((len(m), width - m.shape[1]))))


NAMES = ["query_id", "tag", "vec_id", "score"]


def pieces(batches):
    """(unit, side, rows) of sorted units, as they come."""
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        shard, slab, side = (b.column(c).to_numpy() for c in ("shard", "slab", "side"))
        edge = np.flatnonzero((shard[1:] != shard[:-1]) | (slab[1:] != slab[:-1]) | (side[1:] != side[:-1])) + 1
        for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), n]):
            yield (int(shard[lo]), int(slab[lo])), int(side[lo]), b.slice(lo, hi - lo)


def searcher(build, search, kind: pa.DataType):
    """A mapInArrow function that holds vectors (side 0). build(ids, matrix) makes a part's structure; search(structure, ids, matrix,
    least) gives for each query (row numbers are its own) the arrays query row, vector id, score; scores below `least` needn't be found."""

    def run(batches):
        unit, held, made = None, [], None
        for now, side, part in pieces(batches):
            if unit != now:
                unit, held, made = now, [], None
            if side == 0:
                held.append(part)
                continue
            if not held:
                continue  # a part without vectors
            if made is None:
                ids = np.concatenate([p.column("id").to_numpy() for p in held])
                ms = [matrix(p.column("vec"))[0] for p in held]
                width = max(m.shape[1] for m in ms)
                made = build(ids, np.vstack([fit(m, width) for m in ms]))
            for at in range(0, part.num_rows, BLOCK_ROWS):
                q = part.slice(at, BLOCK_ROWS)
                qi, vi, sc = search(made, q.column("id").to_numpy(), matrix(q.column("vec"))[0], q.column("least").to_numpy())
                row = pa.array(qi)
                yield pa.RecordBatch.from_arrays([q.column("id").take(row), q.column("tag").take(row), pa.array(vi, pa.int64()), pa.array(sc, kind)], names=NAMES)

    return run


def streamed(begin, kind: pa.DataType):
    """A mapInArrow function that holds queries (side 0). begin() makes an object with ask(ids, tags, matrix), which takes a block of
    queries, meet(ids, matrix), which takes a block of vectors in order of id, and found(), blocks of the arrays query id, tag,
    vector id, score."""

    def out(made):
        for q, t, v, s in made.found():
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(t, pa.int64()), pa.array(v, pa.int64()), pa.array(s, kind)], names=NAMES)

    def run(batches):
        unit, made = None, None
        for now, side, part in pieces(batches):
            if unit != now:
                if made is not None:
                    yield from out(made)
                unit, made = now, begin()
            ids, m = part.column("id").to_numpy(), part.column("vec")
            for at in range(0, part.num_rows, STREAM_ROWS):
                block = slice(at, at + STREAM_ROWS)
                dense = matrix(m.slice(at, STREAM_ROWS))[0]
                if side == 0:
                    made.ask(ids[block], part.column("tag").to_numpy()[block], dense)
                else:
                    made.meet(ids[block], dense)
        if made is not None:
            yield from out(made)

    return run


def merged(found: DataFrame, k: int, *more: str) -> DataFrame:
    """query_id, rank, vec_id, score (and more columns): each query's k best of all shards, ties to the smaller id."""
    from pyspark.sql import Window

    w = Window.partitionBy("query_id", "tag").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", *more)
