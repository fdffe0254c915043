"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, decoding by reversing the byte table.

A rank file becomes a byte-level BPE model: every byte stands as a printable character, and each token's splits into two
tokens of lower rank become merges, in order of rank. A piece that is a token itself is taken whole, as rank-based
encoders do. Special tokens are not recognised; their strings are ordinary text.

Spans: the library reports a token's span in characters of the text. Where a character's bytes fall into several tokens,
each of them reports the whole character; `decode` joins bytes before it reads characters, so split characters come back
whole, and `decode_lossy` reads a cut piece with U+FFFD for what is incomplete.

Nulls, ties, repeats: a null text counts as empty; an empty text has no ids and decodes to empty bytes; every row is
encoded on its own, so repeats and null ids are kept; an empty table gives an empty result; further columns stay out.
"""

from __future__ import annotations

import base64
import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import lean, narrow, steps

#: Bytes of text given to the library in one call (a longer text is a call of its own).
CALL_BYTES = 1 << 20


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 for itself, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        chars = byte_characters()
        shown = {token: "".join(chars[b] for b in token) for token in ranks}
        merges = []
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            for k in range(1, len(token)):
                left, right = token[:k], token[k:]
                if ranks.get(left, rank) < rank and ranks.get(right, rank) < rank:
                    merges.append((shown[left], shown[right]))
        self.tokenizer = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.table: list[bytes] = [b""] * (max(ranks.values()) + 1)
        back = {c: b for b, c in enumerate(chars)}
        for text, rank in self.tokenizer.get_vocab().items():
            self.table[rank] = bytes(back[c] for c in text)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_spans(self, texts: list[str]) -> list[tuple[list[int], list[tuple[int, int]]]]:
        """Ids and character spans."""
        return [(e.ids, e.offsets) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8")

    def decode_lossy(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per worker process and file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _encode(path: str, spans: bool):
    @lean
    def run(batches):
        c = codec(path)
        for whole in batches:
            for b in steps(whole, limit=CALL_BYTES):
                texts = [t or "" for t in b.column("text").to_pylist()]
                if spans:
                    got = c.encode_spans(texts)
                    cols = [pa.array([i for i, _ in got], pa.list_(pa.int32())), pa.array([[s for s, _ in o] for _, o in got], pa.list_(pa.int32())), pa.array([[e for _, e in o] for _, o in got], pa.list_(pa.int32()))]
                    yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], names=["doc_id", "ids", "starts", "ends"])
                else:
                    yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(c.encode(texts), pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", spans: bool = False) -> DataFrame:
    """doc_id, ids (and the character spans starts, ends) of every row."""
    slim = narrow(docs, doc_id=id_col, text=text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(_encode(path, spans), f"doc_id {kind}, ids array<int>" + ", starts array<int>, ends array<int>" * spans)


def _decode(path: str):
    @lean
    def run(batches):
        c = codec(path)
        for b in batches:
            out = [c.decode_lossy(ids or ()) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text: the ids read back (whole encodings exactly; cut ones with U+FFFD at the cut). Null ids: empty."""
    slim = narrow(encoded, doc_id=id_col, ids=ids_col)
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(_decode(path), f"doc_id {kind}, text string")


def _round_trip(path: str, keep: list[str]):
    @lean
    def run(batches):
        c = codec(path)
        for whole in batches:
            for b in steps(whole, column="__text", limit=CALL_BYTES):
                ids = c.encode([t or "" for t in b.column("__text").to_pylist()])
                cols = [
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(np.asarray(i, dtype="<u4").tobytes()).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(c.decode_bytes(i)).hexdigest() for i in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], *cols], names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, through the same encoder and decoder."""
    slim = narrow(docs, doc_id=id_col, __text=text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(_round_trip(path, ["doc_id"]), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
