"""Language identification by hyperdimensional profiles.

Each letter has a random vector of DIMENSIONS signs, drawn from a generator seeded with its code point. A letter n-gram is the
product (binding) of its letters' vectors, each permuted (rotated) by its place, and a text is the sum (bundle) of its
n-grams' vectors, word ends included. A language's prototype is the bundle of all its training texts; a text belongs to the
language whose prototype has the largest cosine with its own bundle, and that cosine (0 at least) is the score.

Training reads every labelled text of the training part, bundles within each task, and adds up DIMENSIONS numbers for
each language and task; prediction needs the prototypes alone. Only the letters of a text are looked at.

Texts are counted 256 KB at a time. A longer one is cut into windows of that size with a character of the next ones on either side, which is not
counted there, so its counts are those of the whole and its memory is that of a window.

Nulls, ties, repeats: a null text, or one without a letter, is `und` with score 0, and so is every text if nothing could be
learned; ties go to the language whose name sorts first; rows without a language are not trained on, nor rows without
an id (their part is unknown; held_out is false); every row is predicted on its own, repeated ids included; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm import scan
from tidemark.llm.common import lean, narrow, packed, steps

DIMENSIONS = 512
GRAM = 3
#: N-grams that are turned into vectors at a time, and the largest table of n-gram counts kept as an array.
BLOCK = 8192
TABLE = 1 << 22
#: Bytes of text that are counted at a time: less than elsewhere, as counting takes some hundred bytes for each of them.
STEP_BYTES = 1 << 18

_letters: np.ndarray | None = None
_vectors: dict[int, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it isn't a letter."""
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, dtype=np.int32)
        for m in regex.finditer(r"\p{L}", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))):
            low = m[0].lower()
            table[ord(m[0])] = ord(low) if len(low) == 1 else ord(low[0])
        _letters = table
    return _letters


def letter_vector(code: int) -> np.ndarray:
    """Signs of a letter; code 0 is the end of a word."""
    v = _vectors.get(code)
    if v is None:
        v = _vectors[code] = np.random.default_rng(0x5EED0000 + code).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1
    return v


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Bound vectors of n-grams given as rows of code points."""
    codes, inverse = np.unique(grams, return_inverse=True)
    base = np.stack([letter_vector(int(c)) for c in codes])
    inverse = inverse.reshape(grams.shape)
    out = np.ones((len(grams), DIMENSIONS), dtype=np.int8)
    for k in range(grams.shape[1]):
        out *= np.roll(base, grams.shape[1] - 1 - k, axis=1)[inverse[:, k]]
    return out.astype(np.float32)


def windows(column: pa.Array):
    """A column of texts as it is, or, if it is one text beyond the step, its windows; with whether a window's first and last
    character belong to its neighbours."""
    data, _ = scan.raw(column)
    if len(column) != 1 or len(data) <= STEP_BYTES:
        yield column, False, False
        return
    lead = lambda at, step: at if not 0 < at < len(data) or data[at] & 0xC0 != 0x80 else lead(at + step, step)
    start = 0
    while start < len(data):
        end = lead(min(start + STEP_BYTES, len(data)), 1)
        lo, hi = lead(max(start - 1, 0), -1), lead(min(end + 1, len(data)), 1)
        yield pa.array([data[lo:hi].tobytes().decode()], pa.string()), start > 0, end < len(data)
        start = end


def gram_counts(column: pa.Array, first_apart: bool = False, last_apart: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams (rows of code points); text, n-gram and number of each pair that occurs. Those around the first and last character are left
    out if asked."""
    data, offsets = scan.raw(column)
    lead, cp = scan.code_points(data)
    letters = letter_table()[cp]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(lead, offsets)))
    # one word end between words, and one on either side of each text
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0) | (text[1:] != text[:-1])
    letters, text = letters[keep], text[keep]
    first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1]))) if len(text) else np.zeros(0, np.int64)
    place = np.arange(len(letters))
    edge = np.zeros(len(letters), dtype=np.int64)
    edge[first] = 1
    shift = np.cumsum(edge)
    padded = np.zeros(len(letters) + len(first) + 1, dtype=np.int32)
    owner = np.full(len(padded), -1, dtype=np.int64)
    padded[place + shift] = letters
    owner[place + shift] = text
    width = len(padded) - GRAM + 1
    if width <= 0:
        return np.zeros((0, GRAM), np.int32), *(np.zeros(0, np.int64) for _ in range(3))
    middle = padded[GRAM // 2 : GRAM // 2 + width] != 0  # a gram is read around a letter
    owners = owner[GRAM // 2 : GRAM // 2 + width]
    at = np.flatnonzero(middle & (owners >= 0))
    at = at[(at + GRAM // 2 > first_apart) & (at + GRAM // 2 < len(padded) - 1 - last_apart)]
    codes, small = np.unique(padded, return_inverse=True)
    n = len(codes)
    key = np.zeros(len(at), dtype=np.int64)
    for k in range(GRAM):
        key = key * n + small[at + k]
    if n**GRAM <= TABLE:
        used = np.flatnonzero(np.bincount(key, minlength=1))
        rank = np.zeros(n**GRAM, dtype=np.int64)
        rank[used] = np.arange(len(used))
        gram = rank[key]
    else:
        used, gram = np.unique(key, return_inverse=True)
    table = np.stack([codes[used // n ** (GRAM - 1 - k) % n] for k in range(GRAM)], axis=1) if len(used) else np.zeros((0, GRAM), np.int32)
    pair = owners[at] * max(len(used), 1) + gram
    if (len(offsets) - 1) * len(used) <= 4 * TABLE:
        number = np.bincount(pair, minlength=1)
        pairs = np.flatnonzero(number)
        number = number[pairs]
    else:
        pairs, number = np.unique(pair, return_counts=True)
    return table, pairs // max(len(used), 1), pairs % max(len(used), 1), number


def bundles(rows: int, table: np.ndarray, text: np.ndarray, gram: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Bundle of each of so many rows, from counts of n-grams. Works on BLOCK n-grams at a time."""
    out = np.zeros((rows, DIMENSIONS), dtype=np.float64)
    for lo in range(0, len(table), BLOCK):
        hi = min(lo + BLOCK, len(table))
        here = (gram >= lo) & (gram < hi) if len(table) > BLOCK else slice(None)
        vectors = gram_vectors(table[lo:hi])
        who = np.unique(text[here])
        for a in range(0, len(who), 512):
            some = who[a : a + 512]
            place = np.searchsorted(some, text[here])
            mine = (place < len(some)) & (some[np.minimum(place, len(some) - 1)] == text[here])
            dense = np.zeros((len(some), hi - lo), dtype=np.float32)
            dense[place[mine], gram[here][mine] - lo] = number[here][mine]
            out[some] += dense @ vectors
    return out


@lean
def _train(batches):
    total: dict[str, np.ndarray] = {}
    for whole in batches:
        for b in steps(whole, limit=STEP_BYTES):
            codes = b.column("lang").dictionary_encode()
            lang = codes.indices.to_numpy(zero_copy_only=False)
            names = codes.dictionary.to_pylist()
            for window in windows(b.column("text")):
                table, text, gram, number = gram_counts(*window)
                pair, at = np.unique(lang[text] * max(len(table), 1) + gram, return_inverse=True) if len(text) else (np.zeros(0, np.int64), text)
                sums = np.bincount(at, weights=number, minlength=len(pair))
                made = bundles(len(names), table, pair // max(len(table), 1), pair % max(len(table), 1), sums)
                for name, row in zip(names, made):
                    total[name] = total[name] + row if name in total else row
    names = list(total)
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([total[n].tolist() for n in names], pa.list_(pa.float64()))], names=["lang", "bundle"])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """A prototype for each language: DIMENSIONS numbers for each label reach the driver."""
    slim = narrow(docs, text=text_col, lang=lang_col).where("text is not null and lang is not null")
    parts = slim.mapInArrow(_train, "lang string, bundle array<double>")
    summed = parts.select("lang", F.posexplode("bundle").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():
        out.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["at"]] = r["x"]
    return {k: v for k, v in sorted(out.items()) if v.any()}


def predict_rows(column: pa.Array, names: list[str], prototypes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each text. prototypes: a unit row for each name."""
    rows = len(column)
    made, lettered = np.zeros((rows, DIMENSIONS)), np.zeros(rows, dtype=bool)
    for window in windows(column):
        counts = gram_counts(*window)
        made += bundles(rows, *counts)
        lettered[counts[1]] = True
    norm = np.sqrt((made * made).sum(axis=1))
    if not names:
        return ["und"] * rows, np.zeros(rows)
    cosine = (made @ prototypes.T) / np.maximum(norm, 1e-300)[:, None]
    best = cosine.argmax(axis=1)
    score = np.clip(cosine[np.arange(rows), best], 0.0, 1.0)
    return [names[k] if some else "und" for k, some in zip(best.tolist(), lettered.tolist())], np.where(lettered, score, 0.0)


def _predict(names: list[str], prototypes: np.ndarray, keep: list[str]):
    @lean
    def run(batches):
        for whole in batches:
            for b in steps(whole, column="__text", limit=STEP_BYTES):
                lang, score = predict_rows(b.column("__text"), names, prototypes)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(lang, pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    return run


def unit_rows(model: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray]:
    names = list(model)
    return names, np.stack([model[n] / np.linalg.norm(model[n]) for n in names]) if names else np.zeros((0, DIMENSIONS))


def is_held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: dict[str, np.ndarray] | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score of every row; trains on the rows that aren't held out unless a model is given."""
    if model is None:
        model = train(docs.where(F.col(f"`{id_col}`").isNotNull() & ~is_held_out(id_col)), text_col, lang_col)
    names, prototypes = unit_rows(model)
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), is_held_out(id_col).alias("held_out"), F.col(f"`{text_col}`").alias("__text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(_predict(names, prototypes, ["doc_id", "held_out"]), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def _judge(names: list[str], prototypes: np.ndarray, text_col: str):
    @lean
    def run(batches):
        for whole in batches:
            row = whole.column("row")
            texts = pa.RecordBatch.from_arrays([row.field(text_col), pa.array(np.arange(len(row)))], names=["text", "at"])
            for b in steps(texts, limit=STEP_BYTES):
                lang, score = predict_rows(b.column("text"), names, prototypes)
                yield pa.RecordBatch.from_arrays([row.slice(b.column("at")[0].as_py(), b.num_rows), pa.array(lang, pa.string()), pa.array(score)], names=["row", "lang_pred", "score"])

    return run


def judged(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """row (all columns of docs as a struct, whatever they are called), lang_pred, score."""
    rows = docs.select(packed(docs))
    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(_judge(*unit_rows(model), text_col), schema)
