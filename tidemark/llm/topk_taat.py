"""Exact top-k by integer inner product: exhaustive term-at-a-time accumulation.

Components become floor(scale * x). A task holds a slab of sparse query rows, and vectors pass it in blocks in order of id. A
block is turned into postings by dimension (term): row numbers and integer weights where the weight isn't 0. Query rows
scatter each term's weighted postings into a dense score array (queries x block); where one exceeds a query's k-th score so
far, a partition selection takes the k best of the row, which are merged with those held. A windowed rank merges what tasks found. See
vectors.py for how shards and slabs meet.

Sums are 64-bit integers where magnitudes allow (every component within +-2^24 after scaling); beyond, they are Python
integers, and a total outside 64 bits is held at the limit and ranked as such. Nulls, ties, repeats: rows with a null id, a null vector or a
null or non-finite component take no part, on either side; ties go to the smaller id; rows equal in id and vector count
once, and rows that repeat an id are candidates each, never for their own id; vectors of different lengths count as filled up with 0; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import vectors

SAFE = 1 << 24
LIMITS = (-(1 << 63), (1 << 63) - 1)


def integers(m: np.ndarray, scale: float) -> np.ndarray:
    x = np.floor(m * scale)
    if not x.size or np.abs(x).max() <= SAFE:
        return x.astype(np.int32)
    return np.array([[int(v) if np.isfinite(v) else (LIMITS[1] if v > 0 else LIMITS[0]) for v in row] for row in x], dtype=object)


def postings(weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each term the rows where it isn't 0 and their weights."""
    return [(at := np.flatnonzero(weights[:, t] != 0), weights[at, t]) for t in range(weights.shape[1])]


def accumulate(lists, rows: int, asked: np.ndarray) -> np.ndarray:
    """Scores of a block of query rows against all rows of a shard, term by term."""
    terms = min(len(lists), asked.shape[1])
    kind = object
    if asked.dtype != object and all(w.dtype != object for _, w in lists):
        largest = sum(int(np.abs(asked[:, t]).max(initial=0)) * int(np.abs(lists[t][1]).max(initial=0)) for t in range(terms))
        kind = np.int32 if largest < 1 << 31 else np.int64  # half the memory to pass over where no sum can overflow
    score = np.zeros((len(asked), rows), dtype=kind)
    whole = np.empty_like(score)
    for t in range(terms):
        at, weight = lists[t]
        who = np.flatnonzero(asked[:, t] != 0)
        if not len(at) or not len(who):
            continue
        q, w = asked[who, t].astype(kind), weight.astype(kind)
        if len(at) == rows and len(who) == len(asked):
            np.multiply(q[:, None], w[None, :], out=whole)
            score += whole
        elif len(at) == rows:
            score[who] += q[:, None] * w[None, :]
        else:
            score[np.ix_(who, at)] += q[:, None] * w[None, :]
    return score


def best(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest; rows lie in order of id, so the first of equal ones are taken."""
    n = len(score)
    if n <= k:
        return np.arange(n)
    least = np.partition(score, n - k)[n - k]
    above = np.flatnonzero(score > least)
    return np.concatenate((above, np.flatnonzero(score == least)[: k - len(above)]))


class Slab:
    """A slab of queries and the k best that each has met."""

    def __init__(self, k: int, scale: float):
        self.k, self.scale = k, scale
        self.asked: list[np.ndarray] = []
        self.ids, self.tags = [], []
        self.score = None
        self.last, self.seen = None, set()

    def ask(self, ids: np.ndarray, tags: np.ndarray, m: np.ndarray) -> None:
        for at in range(0, len(ids), vectors.BLOCK_ROWS):
            part = slice(at, at + vectors.BLOCK_ROWS)
            self.asked.append(integers(m[part], self.scale))
            self.ids.append(ids[part])
            self.tags.append(tags[part])

    def _new(self, ids: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Rows that don't repeat the id and vector of another one. Only rows of the last id can come again in the next block."""
        again = np.concatenate((ids[:1] == self.last, ids[1:] == ids[:-1]))
        fresh = np.ones(len(ids), dtype=bool)
        for i in np.flatnonzero(again | np.append(again[1:], True)):
            if ids[i] != self.last:
                self.last, self.seen = ids[i], set()
            bits = hashlib.blake2b(np.trim_zeros(m[i] + 0.0, "b").tobytes(), digest_size=16).digest()
            fresh[i] = bits not in self.seen
            self.seen.add(bits)
        return fresh

    def meet(self, ids: np.ndarray, m: np.ndarray) -> None:
        if not self.asked:
            return
        if self.score is None:
            self.score = [np.zeros((len(x), self.k), dtype=np.int64) for x in self.ids]
            self.place = [np.zeros((len(x), self.k), dtype=np.int64) for x in self.ids]
            self.n = [np.zeros(len(x), dtype=np.int64) for x in self.ids]
        fresh = self._new(ids, m)
        ids, lists = ids[fresh], postings(integers(m[fresh], self.scale))
        for b, asked in enumerate(self.asked):
            score = accumulate(lists, len(ids), asked)
            if score.dtype == object:
                score = np.clip(score, *LIMITS).astype(np.int64)
            better = score > self.score[b][:, -1:]
            low, high = np.searchsorted(ids, self.ids[b], "left"), np.searchsorted(ids, self.ids[b], "right")
            for i in np.flatnonzero(better.any(axis=1) | (self.n[b] < self.k)):
                at = np.flatnonzero(better[i]) if self.n[b][i] == self.k else np.arange(len(ids))
                at = at[(at < low[i]) | (at >= high[i])]
                at = np.sort(at[best(score[i][at], self.k)])
                had = self.n[b][i]
                both, of = np.concatenate((self.score[b][i][:had], score[i][at])), np.concatenate((self.place[b][i][:had], ids[at]))
                order = np.argsort(-both, kind="stable")[: self.k]  # what is held has the smaller ids
                n = self.n[b][i] = len(order)
                self.score[b][i, :n], self.place[b][i, :n] = both[order], of[order]

    def found(self):
        for b, n in enumerate(self.n if self.score is not None else ()):
            there = np.arange(self.k) < n[:, None]
            yield np.repeat(self.ids[b], n), np.repeat(self.tags[b], n), self.place[b][there], self.score[b][there]


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest scores among candidates other than its own id."""
    rows, asked = vectors.usable(candidates, id_col, vec_col), vectors.usable(queries, id_col, vec_col)
    run = vectors.streamed(lambda: Slab(k, scale), pa.int64())
    found = vectors.units(rows, asked).mapInArrow(run, "query_id long, tag long, vec_id long, score long")
    return vectors.merged(found, k)
