"""What one log table has and another lacks, from invertible sketches of their ids.

A sketch has CELLS cells; an id falls into three of them, and each holds how many ids it has and the exclusive ors of their hashes (128 bits) and of a
check of these. Sketches are linear: those of batches add up, and two tables' sketches subtract to that of their difference, whatever
the tables' size. A cell with one id shows it; taken out of its other cells it leaves more such cells, so that some 4,000 ids come
back whole. A batch's ids are read once, when a comparison first meets it, and its sketch is written down; from then on a
comparison of equal tables reads sketches alone.

Ids that come back are looked up in both tables, so one that a table has twice does no harm. If there are too many to decode, or an id three times,
the tables are joined.
"""

from __future__ import annotations

import struct

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.streaming.runs import Runs
from tidemark.tables import Tables

SIDE = 1 << 11
CELLS = 3 * SIDE
CELL = "cell INT, n LONG, x1 LONG, x2 LONG, c LONG"


def hashed(ids: DataFrame, key: str) -> DataFrame:
    """x1, x2: two hashes of each id."""
    return ids.select(F.xxhash64(key).alias("x1"), F.xxhash64(F.lit(1), key).alias("x2"))


def sketch(ids: DataFrame, key: str) -> DataFrame:
    rows = hashed(ids, key).withColumn("c", F.xxhash64(F.col("x1").bitwiseXOR(F.col("x2"))))
    at = [(F.lit(j * SIDE) + F.shiftrightunsigned("x1", 20 * j).bitwiseAND(SIDE - 1)).cast("int") for j in range(3)]
    return rows.select(F.explode(F.array(*at)).alias("cell"), F.lit(1).cast("long").alias("n"), "x1", "x2", "c").groupBy("cell").agg(F.sum("n").alias("n"), *[F.bit_xor(x).alias(x) for x in ("x1", "x2", "c")])


def decoded(cells: dict[int, list[int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]] | None:
    """The (x1, x2) that only the first and only the second side has, from the cells of the difference (n, x1, x2, c); None if some can't be told."""
    check = lambda a, b: struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(struct.pack("<q", a ^ b), seed=42)))[0]  # noqa: E731  as Spark has it
    pure = lambda v: v[0] in (1, -1) and v[3] == check(v[1], v[2])
    sides: dict[int, list[tuple[int, int]]] = {1: [], -1: []}
    todo = [k for k, v in cells.items() if pure(v)]
    while todo:
        v = cells.get(todo.pop())
        if not v or not pure(v):
            continue
        n, a, b, c = v
        sides[n].append((a, b))
        for j in range(3):
            k = j * SIDE + ((a & (1 << 64) - 1) >> 20 * j & SIDE - 1)
            cell = cells.setdefault(k, [0, 0, 0, 0])
            cell[:] = [cell[0] - n, cell[1] ^ a, cell[2] ^ b, cell[3] ^ c]
            todo.append(k)
    return None if any(any(v) for v in cells.values()) else (sides[1], sides[-1])


class Sketches:
    """The sketches of a log table's batches."""

    def __init__(self, tables: Tables, table: str, key: str = "event_id"):
        self.tables, self.table, self.key = tables, table, key
        self.runs = Runs(tables, f"{tables.path(table)}__sketch", CELL)

    def total(self) -> DataFrame:
        """The table's cells; batches that no sketch describes yet are read and get one. Many sketches become one."""
        have = self.runs.described()
        known = {b for bs in have.values() for b in bs}
        if new := [f for f in self.tables.folders(self.table) if f not in known]:
            have[self.runs.write(sketch(self.tables.read(self.table, only=new), self.key).coalesce(1), new)] = new
        seen: set[str] = set()
        for run, of in sorted(have.items(), key=lambda x: -len(x[1])):  # after a crash, those that another one has taken in go
            if seen.issuperset(of):
                self.runs.drop([run])
                del have[run]
            seen.update(of)
        if len(have) > 16:
            have = {self.runs.replace(have, self._sum(self.runs.read(have)).coalesce(1)): []}
        return self._sum(self.runs.read(have))

    @staticmethod
    def _sum(cells: DataFrame) -> DataFrame:
        return cells.groupBy("cell").agg(F.sum("n").alias("n"), *[F.bit_xor(x).alias(x) for x in ("x1", "x2", "c")])


def missing(tables: Tables, sent: str, stored: str, key: str = "event_id") -> DataFrame:
    """Rows of the log table `sent` whose id `stored` lacks. What reaches the driver is CELLS cells at most."""
    ours, theirs = Sketches(tables, sent, key).total(), Sketches(tables, stored, key).total()
    left = Sketches._sum(ours.unionByName(theirs.withColumn("n", -F.col("n")))).where("n <> 0 or x1 <> 0 or x2 <> 0 or c <> 0")
    found = decoded({r["cell"]: [r["n"], r["x1"], r["x2"], r["c"]] for r in left.collect()})
    rows, have = tables.read(sent), tables.read(stored).select(key)
    if found is None:
        return rows.join(have, key, "left_anti").select(*rows.columns)
    if not found[0]:
        return rows.where("false")
    marks = tables.spark.createDataFrame(found[0], "x1 LONG, x2 LONG")
    own = rows.withColumns({"x1": F.xxhash64(key), "x2": F.xxhash64(F.lit(1), key)}).join(marks, ["x1", "x2"], "left_semi").select(*rows.columns)
    there = hashed(have, key).join(marks, ["x1", "x2"], "left_semi")  # those that `sent` has more than once
    gone = own.withColumns({"x1": F.xxhash64(key), "x2": F.xxhash64(F.lit(1), key)}).join(there, ["x1", "x2"], "left_anti")
    return gone.select(*rows.columns)
