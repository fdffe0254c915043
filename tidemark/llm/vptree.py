"""Approximate nearest neighbours by cosine: a vantage-point tree for each shard.

Vectors are laid on the unit sphere, where the order by distance is the order by cosine. A node holds a vantage point
and, for each of its two halves, the smallest and largest distance from it; a half cannot hold anything nearer to a query
at distance d than max(d - largest, smallest - d). It is skipped if `factor` times that bound exceeds the query's k-th
distance so far: factor 1 is the triangle inequality itself and gives exact search, larger ones skip more.
A block of queries first falls to its home leaves, which sets the distances to beat, and then passes the tree once.

Ranking is by the measure itself: wherever a point may be among the k best, its cosine is computed from the original
components in double precision, and places go by (cosine, id). Distances only choose what is looked at, and SLACK, more than
their rounding errors come to, is allowed for when a half is skipped; so factor 1 gives what brute force gives, ties included.

Vectors that are equal but for a power of two have the same cosines to the last bit. They are one point of the tree with
their k + 1 smallest ids, which is all that k neighbours other than the query itself can need; so a vector that a third of
all rows share costs no more than any other.

A shard is a cell of cells.py, or a part of one. A query first searches its own cell; with its k-th cosine there it goes on to
those cells only that the triangle inequality, times `factor` like any other bound, leaves, and their trees begin with that cosine.

Nulls, ties, repeats: rows with a null id, a null or zero vector or a null or non-finite component take no part; ties go
to the smaller id; rows equal in id and vector count once, and rows that repeat an id are never neighbours of their own id; vectors of different lengths count as
filled up with 0; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import cells, vectors
from tidemark.llm.cells import distances, rescaled
from tidemark.llm.common import ship, written

LEAF = 64
FACTOR = 1.2
#: Rounding errors of distances between unit vectors are below it (of a cosine some 1e-15, of a distance near 0 its root).
SLACK = 1e-6
#: Cosines from matrix products and from sums of products differ by less.
BLUR = 1e-12


class Tree:
    """Nodes are tuples: ("leaf", places) or (vantage, near half, far half, four bounds)."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, k: int, seed: int = 0):
        self.k = k
        m = rescaled(m) + 0.0  # -0 and 0 are equal
        bits = np.ascontiguousarray(m).view([("", m.dtype)] * m.shape[1]).ravel() if m.shape[1] else np.zeros(len(m))
        _, first, group = np.unique(bits, return_index=True, return_inverse=True)
        by = np.argsort(group, kind="stable")
        start = np.searchsorted(group[by], np.arange(len(first)))
        self.members = [np.unique(ids[by[a:b]])[: k + 1] for a, b in zip(start, [*start[1:], len(by)])]
        #: the smallest id of each point, and the one that stands for it where that is the query's own (-1: none)
        self.first = np.array([x[0] for x in self.members], dtype=np.int64)
        self.alone = np.array([len(x) == 1 for x in self.members], dtype=bool)
        self.second = np.array([x[min(1, len(x) - 1)] for x in self.members], dtype=np.int64)
        self.original = m[first]
        self.norms = np.sqrt((self.original * self.original).sum(axis=1))
        self.points = self.original / self.norms[:, None]
        self.rng = np.random.default_rng(seed)
        self.root = self._grow(np.arange(len(first)))

    def _grow(self, at: np.ndarray):
        if len(at) <= LEAF:
            return ("leaf", at)
        v = int(at[self.rng.integers(len(at))])
        d = distances(self.points[at], self.points[v : v + 1])[:, 0]
        order = np.argsort(d, kind="stable")
        half = len(at) // 2
        near, far = at[order[:half]], at[order[half:]]
        bounds = (d[order[0]], d[order[half - 1]], d[order[half]], d[order[-1]])
        return (v, self._grow(near), self._grow(far), bounds)

    def search(self, ids: np.ndarray, m: np.ndarray, norms: np.ndarray, least: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Places (-1: none) and cosines of the k best points found for each query: its id, its row, the row's norm and the
        cosine below which nothing is of use."""
        self.ids, self.raw, self.own, self.least = ids, m, norms, least
        self.q = m / norms[:, None]
        self.place = np.full((len(m), self.k), -1, dtype=np.int64)
        self.score = np.full((len(m), self.k), -np.inf)
        home = np.full(len(m), -1, dtype=np.int64)
        self._fall(self.root, np.arange(len(m)), home, [0])
        self._pass(self.root, np.arange(len(m)), home, [0], factor)
        return self.place, self.score

    def _leaf(self, places: np.ndarray, who: np.ndarray) -> None:
        rough = self.q[who] @ self.points[places].T
        row, col = np.nonzero(rough >= self._beat(who)[:, None] - BLUR)
        query, point = who[row], places[col]
        ok = ~(self.alone[point] & (self.first[point] == self.ids[query]))
        query, point = query[ok], point[ok]
        if not len(query):
            return
        exact = np.concatenate([self._cosine(query[lo : lo + 8192], point[lo : lo + 8192]) for lo in range(0, len(query), 8192)])
        some = np.unique(query)
        query = np.concatenate((query, np.repeat(some, self.k)))
        point = np.concatenate((point, self.place[some].ravel()))
        exact = np.concatenate((exact, self.score[some].ravel()))
        stands = np.where(point >= 0, np.where(self.first[point] == self.ids[query], self.second[point], self.first[point]), np.iinfo(np.int64).max)
        order = np.lexsort((stands, -exact, query))
        begin = np.searchsorted(query[order], some)
        best = order[begin[:, None] + np.arange(self.k)]
        self.place[some], self.score[some] = point[best], exact[best]

    def _beat(self, who: np.ndarray) -> np.ndarray:
        return np.maximum(self.score[who, -1], self.least[who])

    def _cosine(self, query: np.ndarray, point: np.ndarray) -> np.ndarray:
        return (self.original[point] * self.raw[query]).sum(axis=1) / (self.norms[point] * self.own[query])

    def _fall(self, node, who, home, counter) -> None:
        """Every query to one leaf; leaves are numbered in the order of the pass."""
        if isinstance(node[0], str):
            if len(who):
                home[who] = counter[0]
                self._leaf(node[1], who)
            counter[0] += 1
            return
        v, near, far, (_, near_max, far_min, _) = node
        d = distances(self.q[who], self.points[v : v + 1])[:, 0] if len(who) else np.zeros(0)
        inside = d <= (near_max + far_min) / 2
        self._fall(near, who[inside], home, counter)
        self._fall(far, who[~inside], home, counter)

    def _pass(self, node, who, home, counter, factor) -> None:
        if isinstance(node[0], str):
            who = who[home[who] != counter[0]]
            if len(who):
                self._leaf(node[1], who)
            counter[0] += 1
            return
        v, near, far, (near_min, near_max, far_min, far_max) = node
        d = distances(self.q[who], self.points[v : v + 1])[:, 0] if len(who) else np.zeros(0)
        for child, low, high in ((near, near_min, near_max), (far, far_min, far_max)):
            bound = np.maximum(np.maximum(d - high, low - d), 0.0)
            reach = np.sqrt(np.maximum(2.0 - 2.0 * self._beat(who), 0.0)) + SLACK
            self._pass(child, who[bound * factor <= reach], home, counter, factor)


def _search(k: int, factor: float):
    def build(ids, m):
        return Tree(ids, m, k)

    def search(tree, query_ids, m, least):
        m = rescaled(m)  # components that the shard's vectors lack count in the norm alone
        norms = np.sqrt((m * m).sum(axis=1))
        place, score = tree.search(query_ids, vectors.fit(m, tree.original.shape[1]), norms, least, factor)
        qi, vi, sc = [], [], []
        for i, q in enumerate(query_ids):
            at = place[i][place[i] >= 0]
            ids = np.concatenate([tree.members[p] for p in at]) if len(at) else np.zeros(0, np.int64)
            each = np.repeat(score[i][: len(at)], [len(tree.members[p]) for p in at])
            other = ids != q
            ids, each = ids[other], each[other]
            top = np.lexsort((ids, -each))[:k]
            qi.append(np.full(len(top), i))
            vi.append(ids[top])
            sc.append(each[top])
        return np.concatenate(qi), np.concatenate(vi), np.concatenate(sc)

    return build, search


def nearest(candidates: DataFrame, queries: DataFrame, k: int = 5, factor: float = FACTOR, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score (cosine): the k nearest found for each query among candidates other than its own id."""
    ship(candidates.sparkSession)
    some = F.exists("vec", lambda x: x != 0)
    rows, asked = vectors.usable(candidates, id_col, vec_col).where(some), vectors.usable(queries, id_col, vec_col).where(some)
    run = vectors.searcher(*_search(k, factor), pa.float64())
    kind = "query_id long, tag long, vec_id long, score double"
    found = lambda units: units.mapInArrow(run, kind)
    grid = cells.Cells(rows)
    if not len(grid.pivots):
        return vectors.merged(rows.sparkSession.createDataFrame([], kind), k)
    home = written(grid.place(vectors.tagged(asked)), "vector-queries").drop("dist")
    first = written(found(grid.meet(home.withColumn("least", F.lit(vectors.NONE)))), "vector-homes")
    reached = F.sort_array(F.collect_list("score"), asc=False)
    kth = vectors.merged(first, k, "tag").groupBy(F.col("query_id").alias("id"), "tag").agg(reached.alias("s"))
    kth = kth.select("id", "tag", F.when(F.size("s") >= k, F.element_at("s", k)).alias("least"))
    known = home.drop("cell").join(kth, ["id", "tag"], "left").fillna(vectors.NONE, ["least"])
    going = written(grid.visits(known, factor, SLACK), "vector-visits")
    others = found(grid.meet(going.select("id", "tag", "vec", "least", F.explode("cells").alias("cell"))))
    return vectors.merged(first.unionByName(others), k)
