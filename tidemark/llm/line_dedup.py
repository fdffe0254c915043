"""Line dedup: range-partitioned line hashes, one streaming pass for first occurrences, a keep bitmap for each document.

A line's key is the line with white space stripped at both ends and A-Z lower-cased. A key of at least `min_chars`
code points that stands in two or more documents stays in the smallest document id only (all its lines there), and
goes from the others.

Only (128-bit key hash, document, line number) rows are shuffled. They are range-partitioned and sorted by hash,
document and position, so the owner of a key is the first row of its run; a run that crosses partitions, which is how a
line found in a third of all documents is dealt out, takes its owner from a table of partition ends that has two rows a
partition. The decisions come back as a deflated bitmap per document, not as text.

Nulls, ties, repeats: a null or empty text is one empty line; a null id counts as one document that sorts after all
others; rows with the same id are the same document (their decisions are kept apart by a hash of the text); an empty
table gives an empty result; further columns pass through apply_keep() untouched.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scan
from tidemark.llm.common import STEP_BYTES, dropped, lean, narrow, packed, release, steps, written

KEYS = "h1 long, h2 long, anon boolean, doc long, rk long, pos int"


def _text_key():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _line_keys(min_chars: int):
    @lean
    def run(batches):
        for whole in batches:
            for b in steps(whole):
                row, number, points, lo, hi, low = scan.lines(b.column("text"))
                keep = points >= min_chars
                h1, h2 = (h.view(np.int64) for h in scan.range_hashes(low, lo[keep], hi[keep]))
                at = pa.array(row[keep])
                doc = b.column("doc").take(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1), pa.array(h2), doc.is_null(), doc.fill_null(0), b.column("rk").take(at), pa.array(number[keep].astype(np.int32))],
                    names=["h1", "h2", "anon", "doc", "rk", "pos"],
                )

    return run


@lean
def _first_occurrences(batches):
    """Over one sorted partition. kind 0: a line to drop; 1: a line of the partition's first key, decided later;
    2: the partition's first key and its first document; 3: the last key and its first document here."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    names = ["part", "kind", "h1", "h2", "anon", "doc", "rk", "pos"]
    head = last = None  # (h1, h2, anon, doc)
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        h1, h2, anon, doc = (b.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "anon", "doc"))
        new = np.ones(n, dtype=bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if last is not None:
            new[0] = (h1[0], h2[0]) != last[:2]
        start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        o_anon, o_doc = anon[np.maximum(start, 0)], doc[np.maximum(start, 0)]
        if last is not None:
            o_anon = np.where(start < 0, last[2], o_anon)
            o_doc = np.where(start < 0, last[3], o_doc)
        if head is None:
            head = (int(h1[0]), int(h2[0]), bool(anon[0]), int(doc[0]))
        in_head = (h1 == head[0]) & (h2 == head[1])
        kind = np.where(in_head, 1, 0).astype(np.int32)
        out = in_head | (anon != o_anon) | (doc != o_doc)
        at = pa.array(np.flatnonzero(out))
        last = (int(h1[-1]), int(h2[-1]), bool(o_anon[-1]), int(o_doc[-1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), part, np.int32)), pa.array(kind[out]), *[b.column(c).take(at) for c in names[2:]]], names=names
        )
    if head is not None:
        ends = list(zip((2, 3), (head, last)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * 2, pa.int32()), pa.array([k for k, _ in ends], pa.int32()), *[pa.array([e[i] for _, e in ends]) for i in range(4)], pa.array([0, 0], pa.int64()), pa.array([0, 0], pa.int32())],
            names=names,
        )


def _head_owners(ends: list) -> list[tuple]:
    """For each partition the owner of its first key, which may have begun in an earlier one. Two rows a partition."""
    by_part: dict[int, dict] = {}
    for r in ends:
        by_part.setdefault(r["part"], {})[r["kind"]] = r
    out, carry = [], None
    for part in sorted(by_part):
        head, last = by_part[part][2], by_part[part][3]
        key = (head["h1"], head["h2"])
        owner = carry[1] if carry and carry[0] == key else (head["anon"], head["doc"])
        out.append((part, *owner))
        last_key = (last["h1"], last["h2"])
        carry = (last_key, owner) if last_key == key else (last_key, (last["anon"], last["doc"]))
    return out


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(anon, doc, rk, pos): each line that goes. rk is a hash of the text that the line stands in."""
    spark = docs.sparkSession
    base = narrow(docs, doc=id_col, text=text_col).select(F.col("doc").cast("long").alias("doc"), "text", _text_key().alias("rk"))
    keys = written(base.mapInArrow(_line_keys(min_chars), KEYS), "line-keys")  # range partitioning reads its input twice
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["h1", "h2", "anon", "doc", "rk", "pos"]
    sorted_keys = keys.repartitionByRange(n, *order).sortWithinPartitions(*order)
    found = written(sorted_keys.mapInArrow(_first_occurrences, "part int, kind int, " + KEYS), "line-firsts")
    dropped(keys)
    release(spark)
    owners = _head_owners(found.where("kind >= 2").select("part", "kind", "h1", "h2", "anon", "doc").collect())
    table = spark.createDataFrame(owners, "part int, o_anon boolean, o_doc long")
    late = found.where("kind = 1").join(F.broadcast(table), "part").where("anon <> o_anon or doc <> o_doc")
    cols = ["anon", "doc", "rk", "pos"]
    return found.where("kind = 0").select(*cols).unionByName(late.select(*cols))


@lean
def _to_bitmaps(batches):
    for b in batches:
        maps = []
        for p in b.column("gone"):
            at = p.values.to_numpy(zero_copy_only=False)
            bits = np.ones((int(at.max()) // 8 + 1) * 8, dtype=np.uint8)
            bits[at] = 0
            maps.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.RecordBatch.from_arrays([b.column("anon"), b.column("doc"), b.column("rk"), pa.array(maps, pa.binary())], names=["anon", "doc", "rk", "keep"])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(anon, doc, rk, keep) for each document that loses lines: deflated bits, 1 = line stays; lines past the end stay.

    A group here is one document's lines, which is bounded by that document's text.
    """
    gone = dropped_lines(docs, id_col, text_col, min_chars)
    return gone.groupBy("anon", "doc", "rk").agg(F.collect_set("pos").alias("gone")).mapInArrow(_to_bitmaps, "anon boolean, doc long, rk long, keep binary")


def kept_text(text: str | None, keep: bytes | None) -> tuple[str, int, int]:
    """The text without its dropped lines, lines before, lines dropped."""
    text = text or ""
    if keep is None:
        return text, text.count("\n") + 1, 0
    parts = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[: len(parts)]
    gone = int((bits == 0).sum())
    flags = bits.tolist() + [1] * (len(parts) - len(bits))
    return "\n".join(p for p, k in zip(parts, flags) if k), len(parts), gone


def with_keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """row (all columns of docs as a struct, whatever they are called) and keep: the bitmap, or null where every line stays."""
    maps = keep_bitmaps(docs, id_col, text_col, min_chars)
    d, t = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    rows = docs.select(packed(docs), d.isNull().alias("anon"), F.coalesce(d, F.lit(0)).alias("doc"), F.xxhash64(F.coalesce(t, F.lit(""))).alias("rk"))
    return rows.join(maps, ["anon", "doc", "rk"], "left").select("row", "keep")


def _kept(batches, text_col: str):
    """Slices of the rows, with what kept_text() makes of each of their texts."""
    for whole in batches:
        row = whole.column("row")
        texts = pa.RecordBatch.from_arrays([row.field(text_col), whole.column("keep"), pa.array(np.arange(len(row)))], names=["text", "keep", "at"])
        for b in steps(texts, limit=4 * STEP_BYTES):
            yield row.slice(b.column("at")[0].as_py(), b.num_rows), list(zip(b.column("text").to_pylist(), b.column("keep").to_pylist()))


@lean
def _digests(batches):
    for row, pairs in _kept(batches, "text"):
        out = [kept_text(*pair) for pair in pairs]
        sha = [hashlib.sha256(text.encode()).hexdigest() for text, *_ in out]
        yield pa.RecordBatch.from_arrays([row.field("doc_id"), pa.array([n for _, n, _ in out], pa.int64()), pa.array([gone for *_, gone in out], pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def line_digests(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    slim = narrow(docs, doc_id="doc_id", text="text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    return with_keep(slim, min_chars=min_chars).mapInArrow(_digests, f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string")


def _rewrite(names, text_col):
    @lean
    def run(batches):
        for row, pairs in _kept(batches, text_col):
            kept = [kept_text(t, k)[0] if k is not None else t for t, k in pairs]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()) if n == text_col else row.field(n) for n in names], names=names)

    return run


def apply_keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """docs with the dropped lines taken out of their texts; all rows and columns stay."""
    return with_keep(docs, id_col, text_col, min_chars).mapInArrow(_rewrite(docs.columns, text_col), docs.schema)
