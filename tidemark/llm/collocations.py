"""Frequent phrases and their cohesion, by vertical positional inverted lists.

Texts are dealt to shards of bounded bytes, one language each. A shard's inverted file has, for each of its words, the sorted list of the
places where it stands; a place is a word's number with a gap at each end of a piece (and of a text), so that words are neighbours exactly if
their places are. Phrases grow by a word at a time: the occurrences of frequent phrases of k words, sorted by place, are merged
with the postings k places further on; what meets is an occurrence of a phrase of k + 1 words, and the list of these is as long as the phrase
is frequent. A longer phrase isn't extended unless both its first and its last k words are frequent.

Which phrases are frequent is found in two steps. First the shards send hashes with the lengths of their lists, packed by ranges of the hash (about four bytes
for a phrase that a task meets once); a range is added up by one task, and hashes that reach the threshold become a filter of bits, whose size follows
their number up to 2^MOST_BITS bits. With the filters of all sizes the shards then send the phrases themselves, pre-aggregated in the shard and
by Spark, so a phrase that has a third of all occurrences is one row a shard; these are added up exactly. What passes a filter wrongly is counted like all others
and then found to be rare, so results don't depend on hashes. Sums, cuts and ranks are DataFrame operations; products are decimals of 38 digits.

Nulls: a null text is empty, a null language is `und` (as is the language of that name). Empty texts have no phrases. A text of any length is cut
only at its words (a shard holds one long text at least). Ties are broken as `collocations` says; repeated rows count each. An empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bit_filter, dropped, lean, narrow, ship, steps, written
from tidemark.llm.scan import LOWER, STREAMS, U64, mix, raw

SHARD_BYTES = 4 << 20
LEAST_BITS, MOST_BITS = 16, 26
#: Words for each range of hashes, and hashes that a task packs at once.
RANGE_WORDS, PACKED = 1 << 19, 1 << 20

#: What a byte is: 0 of a word, 1 blank, 2 an end of a piece.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2

LISTS = "lang string, words array<string>, counts array<int>, places array<int>"


def occurrences(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, and of each word in them its number there and its place."""
    data = LOWER[data]
    kind = KIND[data]
    inside = kind == 0
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    cut[1:] |= kind == 2
    places = np.arange(len(starts)) + np.searchsorted(np.flatnonzero(cut), starts, side="right")
    at = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data[inside]))).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), places.astype(np.int32)


def _one(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _invert(limit: int):
    @lean
    def run(batches):
        for whole in batches:
            for part in steps(whole, limit=limit):
                lang = part.column("lang")
                for name in pc.unique(lang):
                    data, offsets = raw(part.column("text").filter(pc.equal(lang, name)))
                    if not len(data):
                        continue
                    words, code, places = occurrences(data, offsets)
                    if len(code):
                        lists = places[np.argsort(code, kind="stable")]
                        counts = np.bincount(code, minlength=len(words)).astype(np.int32)
                        yield pa.RecordBatch.from_arrays([pa.array([name.as_py()]), *map(_one, (words, pa.array(counts), pa.array(lists)))], names=["lang", "words", "counts", "places"])

    return run


def inverted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, words, counts, places: the inverted file of each shard; places has the words' lists one after the other."""
    ship(docs.sparkSession)
    slim = narrow(docs, text=text_col, lang=lang_col)
    return slim.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")).where("text is not null").mapInArrow(_invert(SHARD_BYTES), LISTS)


def word_hashes(lang: str, words) -> np.ndarray:
    """64 bits of each word of a language."""
    begin = lang.encode() + b"\0"
    return np.array([xxhash.xxh3_64_intdigest(begin + w.encode()) for w in words], dtype=U64)


def chained(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one more word."""
    return mix(h * U64(STREAMS[1] | 1) + word)


def passes(filters: bytes, h: np.ndarray) -> np.ndarray:
    """Which hashes a filter of bits lets through."""
    bits = np.frombuffer(filters, np.uint8)
    at = (h >> U64(64 - (len(bits) * 8).bit_length() + 1)).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def grown(lang: str, words: pa.Array, counts: np.ndarray, lists: np.ndarray, filters: list[bytes], exact: bool):
    """Of a shard, for phrases of 2, 3, ... words: the number of each occurrence's first word among those of frequent words, the phrase's hash, and its
    number among the shard's phrases (if exact); and the words. Phrases of as many words as there are filters have passed theirs, the last ones, one word longer,
    haven't any."""
    hashes = word_hashes(lang, words.to_pylist())
    frequent = np.repeat(passes(filters[0], hashes), counts)
    place, word = lists[frequent], np.repeat(np.arange(len(words)), counts)[frequent]
    order = np.argsort(place)
    place, word = place[order], word[order]
    start, h, code, first = place, hashes[word], word, np.arange(len(place))
    for k in range(1, len(filters) + 1):
        # merge of the phrases' places with the postings k places on, and with the phrases one place on
        to = np.searchsorted(place, start + k)
        met = np.append(start[1:] == start[:-1] + 1, False)[: len(start)]
        met &= place[np.minimum(to, len(place) - 1)] == start + k
        next_word = word[to[met]]
        start, first, h = start[met], first[met], chained(h[met], hashes[next_word])
        code = code[met] * len(words) + next_word if exact else None
        if k < len(filters):
            stay = passes(filters[k], h)
            start, first, h = start[stay], first[stay], h[stay]
            code = np.unique(code[stay], return_inverse=True)[1] if exact else None
        if len(start):
            yield k + 1, first, h, code, word


def _shards(batches):
    for b in batches:
        for i in range(b.num_rows):
            words, counts, lists = (b.column(c)[i].values for c in ("words", "counts", "places"))
            yield b.column("lang")[i].as_py(), words, counts.to_numpy(), lists.to_numpy()


def _packed_hashes(filters: list[bytes], ranges: int):
    """Hashes of phrases one word longer than there are filters: by range (their first `ranges` bits) the next 32 bits, of those that a task's
    shards have once, and of the others with their number."""

    def packed(keys, n):
        keys, at = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(at, np.concatenate(n)).astype(U64)
        part, rest, once = (keys >> U64(32)).astype(np.int64), keys.astype(np.uint32), n == 1
        found = np.unique(part)
        cut = lambda some: np.searchsorted(part[some], np.append(found, 1 << ranges))
        pack = lambda x, at: pa.BinaryArray.from_buffers(pa.binary(), len(found), [None, pa.py_buffer((x.itemsize * at).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])
        more = rest[~once].astype(U64) << U64(32) | n[~once]
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pack(rest[once], cut(once)), pack(more, cut(~once))], names=["part", "once", "more"])

    @lean
    def run(batches):
        keys, counted, held = [], [], 0
        for lang, words, counts, lists in _shards(batches):
            for size, _, h, _, _ in grown(lang, words, counts, lists, filters, False):
                if size > len(filters):
                    key, n = np.unique(h >> U64(32 - ranges), return_counts=True)
                    keys.append(key)
                    counted.append(n)
                    held += len(key)
            if held > PACKED:
                yield packed(keys, counted)
                keys, counted, held = [], [], 0
        if held:
            yield packed(keys, counted)

    return run


def _reached(least: int):
    """Keys (range and 32 bits) whose numbers add up to `least`, of rows sorted by range."""

    def out(part, once, more):
        more = np.frombuffer(b"".join(more), U64)
        rest = np.concatenate((np.frombuffer(b"".join(once), np.uint32), (more >> U64(32)).astype(np.uint32)))
        n = np.concatenate((np.ones(len(rest) - len(more)), (more & U64(0xFFFFFFFF)).astype(np.float64)))
        keys, at = np.unique(rest, return_inverse=True)
        keys = keys[np.bincount(at, n) >= least].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys | part << 32, pa.int64())], names=["key"])

    @lean
    def run(batches):
        part, once, more = None, [], []
        for b in batches:
            for p, x, y in zip(*[b.column(c).to_pylist() for c in ("part", "once", "more")]):
                if p != part:
                    if part is not None:
                        yield out(part, once, more)
                    part, once, more = p, [], []
                once.append(x)
                more.append(y)
        if part is not None:
            yield out(part, once, more)

    return run


def _spelt(filters: list[bytes]):
    """The phrases that pass all filters, and the lengths of their lists."""

    @lean
    def run(batches):
        for lang, words, counts, lists in _shards(batches):
            for size, first, _, code, word in grown(lang, words, counts, lists, filters, True):
                if size > len(filters):
                    continue
                _, at, n = np.unique(code, return_index=True, return_counts=True)
                text = pc.binary_join_element_wise(*[words.take(pa.array(word[first[at] + j])) for j in range(size)], " ")
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(lang, len(n)), pa.string()), pa.array(np.full(len(n), size, np.int32)), text, pa.array(n, pa.int64())], names=["lang", "size", "phrase", "n"])

    return run


def _word_keys(ranges: int):
    def run(batches):
        for b in batches:
            h = np.zeros(b.num_rows, dtype=U64)
            lang = b.column("lang")
            for name in pc.unique(lang).to_pylist():
                at = np.flatnonzero(pc.equal(lang, name).to_numpy(zero_copy_only=False))
                h[at] = word_hashes(name, b.column("phrase").take(pa.array(at)).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array((h >> U64(32 - ranges)).astype(np.int64))], names=["key"])

    return run


def _filter(keys: DataFrame, ranges: int) -> bytes:
    bits = min(max((32 * keys.count()).bit_length(), LEAST_BITS), MOST_BITS, 32 + ranges)
    return bit_filter(keys.select(F.shiftright("key", 32 + ranges - bits).alias("place")), bits)


def frequent_phrases(lists: DataFrame, least: int = 30, longest: int = 4) -> DataFrame:
    """lang, size, phrase, f of all phrases of up to `longest` words with at least `least` occurrences, a written table."""
    spark = lists.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_words = lists.select(F.sum(F.size("places"))).first()[0] or 0
    ranges = min((8 + n_words // RANGE_WORDS).bit_length(), 30)
    counts = lists.select("lang", F.inline(F.arrays_zip(F.col("words").alias("phrase"), F.col("counts").cast("array<long>").alias("n"))))
    keep = lambda found: found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    words = written(keep(counts.withColumn("size", F.lit(1))), "words")
    filters = [_filter(words.mapInArrow(_word_keys(ranges), "key long"), ranges)]
    for _ in range(1, longest):
        sent = lists.mapInArrow(_packed_hashes(list(filters), ranges), "part long, once binary, more binary")
        keys = written(sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_reached(least), "key long"), "keys")
        filters.append(_filter(keys, ranges))
        dropped(keys)
    spelt = keep(lists.mapInArrow(_spelt(filters), "lang string, size int, phrase string, n long"))
    return written(words.unionByName(spelt), "phrases")


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, inside: int = 80, scale: int = 2_000_000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of 2 to `longest` words that occur `least` times or more.

    n are the language's words, a the phrase's occurrences, l and r those of the two parts of its weakest cut: the one of the least score
    floor(scale * a / (l + r)), of equal ones the first. Phrases within a longer one that has `inside` percent of their occurrences or more are
    left out. Order: score, then a, both descending, then the phrase's bytes.
    """
    lists = written(inverted(docs, text_col, lang_col), "inverted")
    every = frequent_phrases(lists, least, longest)
    words = written(lists.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n")), "words")
    dropped(lists)
    candidates = every.where("size >= 2").withColumnRenamed("f", "a")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - size)"))
    of = lambda part, name: every.where(f"size < {longest}").select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    both = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    scored = both.withColumn("score", F.expr(f"(cast(a as decimal(19,0)) * {scale}) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    parts = F.split("phrase", " ")
    within = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice(parts, i, m), " "))))
    longer = candidates.where("size >= 3").select("lang", F.explode(within).alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * inside))
    flat = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    best = flat.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
