"""Cells of vectors by their nearest pivot, and which of them a query has to visit.

Pivots are distinct vectors of the table, those whose hashes are smallest: as many as the square root of the rows over
vectors.SHARD_SCALE, but no more than PIVOTS and than PIVOT_BYTES hold, which is what bounds all that goes to the driver and
to each task. Every vector is placed; a cell too large for one task is cut by id into parts of at most PART_BYTES.

Of a cell are known the smallest and the largest distance from its pivot. On the unit sphere, as anywhere, nothing in it is nearer
to a query at distance d from the pivot than d - largest or smallest - d; and nothing in it is nearer than the plane
halfway between its pivot and the query's nearest one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors
from tidemark.llm.common import written

PIVOTS = 2048
PIVOT_BYTES = 16 << 20
PART_BYTES = 64 << 20
#: Pivots whose distances to a vector differ by less are equally near; the first of them has it.
EVEN = 1e-9
#: Pivots nearer to each other say nothing by the plane between them.
APART = 0.02


def rescaled(m: np.ndarray) -> np.ndarray:
    """Rows by a power of two, which leaves cosines as they are, so that their largest component is between a half and 1."""
    top = np.abs(m).max(axis=1) if m.size else np.ones(len(m))
    return np.ldexp(m, -np.frexp(np.where(top > 0, top, 1.0))[1][:, None])


def units_of(m: np.ndarray) -> np.ndarray:
    m = rescaled(m)
    return m / np.sqrt((m * m).sum(axis=1))[:, None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit rows."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def nearest_pivot(pivots: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of its pivot and its distances to all."""
    d = distances(vectors.fit(units_of(m), pivots.shape[1]), pivots)
    return np.argmax(d <= d.min(axis=1)[:, None] + EVEN, axis=1), d


class Cells:
    """The placed rows (cell, dist, id, vec; written) and what is known of each cell."""

    def __init__(self, rows: DataFrame):
        n, width = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
        self.width = max(1, width or 1)
        self.pivots = _pivots(rows, n, self.width)
        if not n:
            return
        self.placed = written(self.place(rows), "vector-cells")
        known = self.placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")).collect()
        size, self.low, self.high = np.zeros(len(self.pivots), np.int64), np.full(len(self.pivots), np.inf), np.zeros(len(self.pivots))
        for r in known:
            size[r["cell"]], self.low[r["cell"]], self.high[r["cell"]] = r["n"], r["low"], r["high"]
        self.parts = -(-size * 8 * self.width // PART_BYTES)
        self.first = np.cumsum(self.parts) - self.parts

    def place(self, rows: DataFrame) -> DataFrame:
        """rows and, for each, its cell and the distance from its pivot."""
        pivots = self.pivots

        def run(batches):
            for b in batches:
                for at in range(0, b.num_rows, vectors.BLOCK_ROWS):
                    part = b.slice(at, vectors.BLOCK_ROWS)
                    cell, d = nearest_pivot(pivots, vectors.matrix(part.column("vec"))[0])
                    more = [pa.array(cell, pa.int32()), pa.array(d[np.arange(len(cell)), cell], pa.float64())]
                    yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, "cell", "dist"])

        return rows.mapInArrow(run, f"{_ddl(rows)}, cell int, dist double")

    def visits(self, queries: DataFrame, factor: float, slack: float) -> DataFrame:
        """queries (with `least`, the cosine to reach) and `cells`, which beside the own one can hold as much by `factor` times their bound."""
        pivots, low, high, there = self.pivots, self.low, self.high, self.parts > 0

        def run(batches):
            between = distances(pivots, pivots)
            for b in batches:
                for at in range(0, b.num_rows, vectors.BLOCK_ROWS):
                    part = b.slice(at, vectors.BLOCK_ROWS)
                    home, d = nearest_pivot(pivots, vectors.matrix(part.column("vec"))[0])
                    own = d[np.arange(len(home)), home][:, None]
                    gap = between[home]
                    plane = np.where(gap >= APART, (d * d - own * own) / (2 * np.maximum(gap, APART)), 0.0)
                    bound = np.maximum(np.maximum(d - high, low - d), np.maximum(plane, 0.0))
                    least = part.column("least").to_numpy()
                    reach = np.sqrt(np.maximum(2.0 - 2.0 * least, 0.0)) + slack
                    go = (bound * factor <= reach[:, None]) & there
                    go[np.arange(len(home)), home] = False
                    ends = np.concatenate(([0], np.cumsum(go.sum(axis=1))))
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.nonzero(go)[1], pa.int32()))
                    yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "cells"])

        return queries.mapInArrow(run, f"{_ddl(queries)}, cells array<int>")

    def meet(self, asked: DataFrame) -> DataFrame:
        """Units as vectors.units gives them, of queries (cell, id, vec, tag, least) and the rows of their cells. A cell's rows are
        sent once for each slab of the queries that come to it, not at all if none does. `asked` is read twice."""
        coming = np.zeros(len(self.pivots), np.int64)
        for r in asked.groupBy("cell").count().collect():
            coming[r["cell"]] = r["count"]
        slabs = -(-coming // vectors.SLAB_ROWS)
        slabs_of, parts_of, first_of = (_pick(x) for x in (slabs, self.parts, self.first))
        up_to = lambda n: F.sequence(F.lit(0), n - 1)
        part = F.pmod(F.xxhash64("id"), parts_of).cast("int")
        base = self.placed.where((slabs_of > 0) & (parts_of > 0))
        base = base.select((first_of + part).alias("shard"), F.explode(up_to(slabs_of)).alias("slab"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("tag"), "id", "vec", F.lit(0.0).alias("least"))
        slab = F.pmod(F.xxhash64("id"), slabs_of).cast("int")
        come = asked.where((slabs_of > 0) & (parts_of > 0)).select("cell", F.explode(up_to(parts_of)).alias("part"), slab.alias("slab"), "tag", "id", "vec", "least")
        come = come.select((first_of + F.col("part")).alias("shard"), "slab", F.lit(1).alias("side"), "tag", "id", "vec", "least")
        return vectors.sent(base.unionByName(come), int((slabs * self.parts).sum()))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _pick(values: np.ndarray) -> Column:
    """The value of a row's cell; as many as there are pivots at most, so they go with the plan."""
    return F.element_at(F.lit([int(v) for v in values]).cast("array<int>"), F.col("cell") + 1)


def _pivots(rows: DataFrame, n: int, width: int) -> np.ndarray:
    """Unit vectors of so many distinct rows; however many copies a vector has, it is one pivot."""
    most = max(1, min(PIVOTS, PIVOT_BYTES // (8 * width), math.ceil(math.sqrt(n / vectors.SHARD_SCALE))))
    hashed = rows.select(F.xxhash64("vec").alias("h"), "id", "vec")
    few = hashed.groupBy("h").agg(F.min("id").alias("id")).orderBy("h").limit(most)
    found = hashed.join(F.broadcast(few), ["h", "id"], "left_semi").dropDuplicates(["h"]).orderBy("h").select("vec").collect()
    out = np.zeros((len(found), width))
    for i, r in enumerate(found):
        out[i, : len(r["vec"])] = r["vec"]
    return units_of(out) if len(out) else out
