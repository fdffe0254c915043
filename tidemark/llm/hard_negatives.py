"""Hard negatives: for each anchor its nearest rows of its own label, and near each of these the best rows of other labels.

Components become integers, floor(scale * x), and a score is an integer inner product. Vectors are quantised by products: each run of SUB components
has up to CODES centroids, fitted on at most SAMPLE_ROWS rows (those of the smallest hashes; the fit decides how much is pruned, never what is found). A stored row is its vector, a code for each
run and the norm of what the code leaves over in each run, rounded up. An anchor's table of inner products with all centroids gives a score
by lookup; the true one lies within the sum over runs of anchor's norm times residual norm. So

* a row whose upper bound is below the k-th score so far, or below the k-th largest lower bound among rows that surely count, is out;
* for a window [lo, hi] a row goes on only if its bounds reach into the window;
* what is left is scored anew in exact integers, which alone decide.

Anchors lie in slabs of bounded bytes that a task holds; rows are streamed past them in blocks in order of id, as vectors.py says. Positives: rows
are dealt to shards by label and hash, and an anchor goes to the shards of its label only; a label with a third of all rows is as many shards as others,
cut by hash. Negatives: every shard meets every anchor with its windows. What a task gives back are k rows for an anchor
or window.

Nulls: rows with a null id, label or vector, or a null or non-finite component take no part. Ties go to the smaller id. Rows equal in id, label and
vector count once; others that repeat an id are rows each, never for their own id. Vectors of different lengths count as filled up with 0. Totals
outside 64 bits are held at the limit and ranked as such. An anchor without positives, and a window without rows, give none; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import vectors
from tidemark.llm.common import lean, narrow, ship, written
from tidemark.llm.topk_taat import LIMITS, integers

SUB, CODES, SAMPLE_ROWS, ROUNDS = 4, 256, 8192, 8
SLAB_BYTES = 16 << 20
#: Rows that meet a block of anchors at once, and anchors in a block.
BLOCK, ANCHORS = 8192, 128

STORED = "id long, label long, tag long, vec array<double>, codes binary, norms array<float>"


def usable(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """id, label, vec, tag of the rows that take part; a tag tells rows of one id apart."""
    v = narrow(rows, id=id_col, vec=vec_col, label=label_col).select(F.col("id").cast("long"), F.col("label").cast("long"), F.col("vec").cast("array<double>"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return v.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & fine).withColumn("tag", F.xxhash64("id", "label", "vec"))


def _floats(m: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(m * scale)


def _runs(x: np.ndarray, width: int) -> np.ndarray:
    """Rows, runs, components; the last run is filled up with 0."""
    runs = max(1, -(-width // SUB))
    return vectors.fit(x, runs * SUB).reshape(len(x), runs, SUB)


class Codebook:
    """Centroids of each run (runs, codes, SUB), fitted by Lloyd's rounds from rows of the sample."""

    def __init__(self, sample: np.ndarray, width: int):
        self.width = width
        x = _runs(sample if len(sample) else np.zeros((1, width)), width).transpose(1, 0, 2)
        x = np.nan_to_num(x, posinf=0.0, neginf=0.0)
        n = min(CODES, x.shape[1])
        pick = np.random.default_rng(7).permutation(x.shape[1])[:n]
        self.centroids = x[:, pick].copy()
        for _ in range(ROUNDS):
            for run, c in zip(x, self.centroids):
                near = self._nearest(run, c)
                n_of = np.bincount(near, minlength=n)
                for d in range(SUB):
                    total = np.bincount(near, run[:, d], minlength=n)
                    c[n_of > 0, d] = total[n_of > 0] / n_of[n_of > 0]

    @staticmethod
    def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            return np.argmin((c * c).sum(axis=1) - 2 * x @ c.T, axis=1)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows, runs), and the norms of what they leave over, rounded up; infinite where that is unknown."""
        runs = _runs(x, self.width)
        codes, norms = np.zeros(runs.shape[:2], np.uint8), np.zeros(runs.shape[:2], np.float32)
        for m, c in enumerate(self.centroids):
            codes[:, m] = self._nearest(runs[:, m], c)
            with np.errstate(all="ignore"):
                left = runs[:, m] - c[codes[:, m]]
                norms[:, m] = np.nextafter(np.sqrt((left * left).sum(axis=1)).astype(np.float32) * np.float32(1 + 1e-6), np.float32(np.inf))
        return codes, np.where(np.isnan(norms), np.float32(np.inf), norms)

    def tables(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For anchors: their inner products with each centroid (runs, anchors, codes), their runs' norms, and what rounding may
        take from a lookup score."""
        runs = _runs(asked, self.width)
        with np.errstate(all="ignore"):
            norms = np.sqrt((runs * runs).sum(axis=2)) * (1 + 1e-12)
            largest = np.sqrt((self.centroids**2).sum(axis=2).max(axis=1).sum())
            return np.matmul(runs.transpose(1, 0, 2), self.centroids.transpose(0, 2, 1)), norms, 1e-9 * np.sqrt((norms**2).sum(axis=1)) * (largest + 1)


def quantised(rows: DataFrame, scale: float) -> tuple[DataFrame, Codebook]:
    """The rows with codes and residual norms, a written table, and the codebook. The sample is bounded by SAMPLE_ROWS."""
    width = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    sample = [r["vec"] for r in rows.orderBy("tag", "id").limit(SAMPLE_ROWS).select("vec").collect()]
    m = vectors.matrix(pa.array(sample, pa.list_(pa.float64())))[0] if sample else np.zeros((0, width))
    book = Codebook(_floats(vectors.fit(m, width), scale), width)

    @lean
    def encode(batches):
        for b in batches:
            if not b.num_rows:
                continue
            codes, norms = book.encode(_floats(vectors.fit(vectors.matrix(b.column("vec"))[0], width), scale))
            at = pa.array(np.arange(len(norms) + 1) * norms.shape[1], pa.int32())
            kept = [b.column(c) for c in ("id", "label", "tag", "vec")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([c.tobytes() for c in codes], pa.binary()), pa.ListArray.from_arrays(at, pa.array(norms.ravel()))], names=["id", "label", "tag", "vec", "codes", "norms"])

    return written(rows.select("id", "label", "tag", "vec").mapInArrow(encode, STORED), "quantised"), book


class Slab:
    """Anchors, each with windows of scores, and the k best rows that each window has met. `same`: rows of the anchor's label count, else
    those of all others."""

    def __init__(self, book: Codebook, scale: float, k: int, same: bool):
        self.book, self.scale, self.k, self.same = book, scale, k, same
        self.blocks: list[tuple] = []
        self.last = None

    def ask(self, ids, tags, labels, m: np.ndarray, windows: list[list[tuple[int, int]]]) -> None:
        m = vectors.fit(m, self.book.width)
        for at in range(0, len(ids), ANCHORS):
            part = slice(at, at + ANCHORS)
            held = [[[] for _ in w] for w in windows[part]]
            self.blocks.append((ids[part], tags[part], labels[part], integers(m[part], self.scale), _floats(m[part], self.scale), windows[part], held))

    def _fresh(self, ids: np.ndarray, tags: np.ndarray) -> np.ndarray:
        new = np.ones(len(ids), dtype=bool)
        new[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])
        new[0] = (ids[0], tags[0]) != self.last
        self.last = (ids[-1], tags[-1])
        return new

    def meet(self, ids, tags, labels, m: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> None:
        new = self._fresh(ids, tags)
        ids, labels, m, codes, norms = ids[new], labels[new], vectors.fit(m[new], self.book.width), codes[new], norms[new].astype(np.float64)
        whole, columns = integers(m, self.scale), np.ascontiguousarray(codes.T)
        for own, _, of, asked, floats, windows, held in self.blocks:
            tables, sizes, slack = self.book.tables(floats)
            with np.errstate(all="ignore"):
                score = np.zeros((len(own), len(ids)))
                for table, column in zip(tables, columns):
                    score += table[:, column]
                reach = sizes @ norms.T + slack[:, None]
                reach += 1e-9 * reach
            for i in range(len(own)):
                ok = ((labels == of[i]) == self.same) & (ids != own[i])
                with np.errstate(all="ignore"):
                    low, high = score[i] - reach[i], score[i] + reach[i]
                low, high = np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)
                self._complete(ids, whole, asked[i], ok, low, high, windows[i], held[i])

    def _complete(self, ids, whole, anchor, ok, low, high, windows, held) -> None:
        wanted = []
        for (lo, hi), best in zip(windows, held):
            go = ok & (high >= lo) & (low <= hi)
            if len(best) == self.k:
                go &= high >= -best[-1][0]
            sure = low[go & (low >= lo) & (high <= hi)]
            if len(sure) >= self.k:
                go &= high >= np.partition(sure, len(sure) - self.k)[len(sure) - self.k]
            wanted.append(go)
        at = np.flatnonzero(np.logical_or.reduce(wanted)) if wanted else ()
        if not len(at):
            return
        exact = _exact(whole[at], anchor)
        for (lo, hi), best in zip(windows, held):
            hit = np.flatnonzero((exact >= lo) & (exact <= hi))
            if len(hit) > self.k:
                least = np.partition(exact[hit], len(hit) - self.k)[len(hit) - self.k]
                hit = hit[exact[hit] >= least]
            # whatever is in a window but wasn't wanted by it can't be among its best; it does no harm here
            best[:] = sorted([*best, *((-int(exact[j]), int(ids[at[j]])) for j in hit)])[: self.k]

    def found(self):
        for own, tags, _, _, _, _, held in self.blocks:
            out = [(int(own[i]), int(tags[i]), w, j, -s) for i in range(len(own)) for w, best in enumerate(held[i]) for s, j in best]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["query_id", "tag", "window", "vec_id", "score"])


def _exact(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    if rows.dtype != object and anchor.dtype != object:
        if rows.shape[1] * float(np.abs(rows).max(initial=0)) * float(np.abs(anchor).max(initial=0)) < 2**53:
            return (rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
        return rows.astype(np.int64) @ anchor.astype(np.int64)
    return np.clip((rows.astype(object) * anchor.astype(object)).sum(axis=1), *LIMITS).astype(np.int64)


def _task(begin):
    """A mapInArrow function over sorted units: anchors first (side 0), then rows."""

    @lean
    def run(batches):
        unit, slab = None, None
        for now, side, part in vectors.pieces(batches):
            if unit != now:
                if slab is not None:
                    yield from slab.found()
                unit, slab = now, begin()
            for at in range(0, part.num_rows, BLOCK):
                b = part.slice(at, BLOCK)
                ids, tags, labels = (b.column(c).to_numpy() for c in ("id", "tag", "label"))
                m = vectors.matrix(b.column("vec"))[0]
                if side == 0:
                    slab.ask(ids, tags, labels, m, [[(w["lo"], w["hi"]) for w in ws] for ws in b.column("windows").to_pylist()])
                elif slab.blocks:
                    codes = np.frombuffer(b"".join(b.column("codes").to_pylist()), np.uint8).reshape(len(ids), -1)
                    slab.meet(ids, tags, labels, m, codes, b.column("norms").flatten().to_numpy().reshape(len(ids), -1))
        if slab is not None:
            yield from slab.found()

    return run


def _met(rows: DataFrame, anchors: DataFrame, book: Codebook, scale: float, k: int, same: bool, counts: tuple[int, int]) -> DataFrame:
    """query_id, tag, window, vec_id, score: the k best of each window, ranked."""
    n_rows, n_asked = counts
    shards = max(1, int(np.ceil(np.sqrt(n_rows / vectors.SHARD_SCALE))), -(-n_rows // vectors.SHARD_ROWS))
    slabs = max(1, -(-n_asked * 8 * max(1, book.width) // SLAB_BYTES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod("tag", F.lit(n)).cast("int")
    # rows of two labels in one shard do no harm: labels are compared
    shard = lambda c: F.pmod(F.xxhash64("label", c), F.lit(1 << 30)).cast("int") if same else F.col(c)
    none = F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>")
    base = rows.select("*", none.alias("windows"), dealt(shards).alias("part"), every(slabs).alias("slab"), F.lit(1).alias("side"))
    asked = anchors.select("*", dealt(slabs).alias("slab"), F.lit(0).alias("side"), every(shards).alias("part"))
    both = base.unionByName(asked).withColumn("shard", shard("part")).drop("part")
    parts = max(shards * slabs, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sent = both.repartition(parts, "shard", "slab").sortWithinPartitions("shard", "slab", "side", "id", "tag")
    found = sent.mapInArrow(_task(lambda: Slab(book, scale, k, same)), "query_id long, tag long, window int, vec_id long, score long")
    w = Window.partitionBy("query_id", "tag", "window").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor (a row of `anchors`, which are rows of the table) and each of its `positives` best rows of the same label the `negatives` best
    rows of other labels that satisfy low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    ship(rows.sparkSession)
    table, book = quantised(usable(rows, id_col, vec_col, label_col), scale)
    chosen = usable(anchors, id_col, vec_col, label_col).select("id", "tag").distinct()
    own = written(table.join(chosen, ["id", "tag"]).dropDuplicates(["id", "tag"]), "anchors").select("id", "label", "tag", "vec", "codes", "norms")
    counts = table.count(), own.count()
    whole = F.array(F.struct(F.lit(LIMITS[0]).alias("lo"), F.lit(LIMITS[1]).alias("hi")))
    near = written(_met(table, own.withColumn("windows", whole), book, scale, positives, True, counts).withColumnRenamed("rank", "nth"), "positives")
    # bounds of a window by whole division, in decimals: products may pass 64 bits
    wide = F.col("score").cast("decimal(19,0)")
    bound = lambda c: c.cast("long")
    ranked = near.select(F.col("query_id").alias("id"), "tag", F.struct(F.col("nth"), bound(F.ceil(wide * low / 100)).alias("lo"), bound(F.floor(wide * high / 100)).alias("hi")).alias("w"))
    lists = ranked.groupBy("id", "tag").agg(F.array_sort(F.collect_list("w")).alias("w"))
    windows = lists.select("id", "tag", F.transform("w", lambda w: F.struct(w["lo"].alias("lo"), w["hi"].alias("hi"))).alias("windows"))
    found = _met(table, own.join(windows, ["id", "tag"]), book, scale, negatives, False, counts)
    pairs = found.withColumn("nth", F.col("window") + 1).join(near.select("query_id", "tag", "nth", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), ["query_id", "tag", "nth"])
    return pairs.select(F.col("query_id").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
