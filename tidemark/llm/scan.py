"""Vectorised scanning of UTF-8 text: words, lines and their hashes, over all texts of an Arrow slice at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
#: Constants of a 64-bit finaliser, and of independent streams.
MIX_A, MIX_B = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
STREAMS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)

#: Masks of the first k of eight bytes.
BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U64)
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * MIX_A
    x = x ^ (x >> U64(27))
    x = x * MIX_B
    return x ^ (x >> U64(31))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each begins and ends (n + 1 offsets). A null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run of non-white bytes, and per text the index of its first one (n + 1)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~WHITE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def digests(pieces) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes (XXH3, which isn't linear in its input) of byte strings, as two arrays of 64 bits."""
    out = np.frombuffer(b"".join([xxhash.xxh3_128_digest(p) for p in pieces]), dtype=">u8").reshape(-1, 2)
    return out[:, 0].astype(U64), out[:, 1].astype(U64)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of byte ranges (words, lines); equal ranges have equal hashes wherever they stand.

    Up to 15 bytes and their number are 128 bits themselves, which a bijection spreads: no two such ranges share a hash.
    Longer ones go through digests().
    """
    size = ends - starts
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    at = np.ndarray((len(data) + 9,), dtype="<u8", buffer=padded, strides=(1,))  # eight bytes from every place on
    held = np.minimum(size, 15)
    x = at[starts] & BYTES[np.minimum(held, 8)]
    y = (at[starts + 8] & BYTES[np.maximum(held - 8, 0)]) | held.astype(U64) << U64(56)
    for s in STREAMS[:2]:
        x ^= mix(y ^ U64(s))
        y ^= mix(x + U64(s))
    long = np.flatnonzero(size > 15)
    if len(long):
        text = data.tobytes()
        x[long], y[long] = digests([text[lo:hi] for lo, hi in zip(starts[long].tolist(), ends[long].tolist())])
    return x, y


def _window(h: np.ndarray, first: np.ndarray, count: np.ndarray, out_at: np.ndarray, n: int) -> np.ndarray:
    """The hash of every n words one after the other, from the words' own; of all of them where there are fewer."""
    coef = mix(np.arange(1, n + 1, dtype=U64) * U64(STREAMS[1])) | U64(1)
    out = np.zeros(out_at[-1], dtype=U64)
    each = np.diff(out_at)
    if len(h) >= n:
        rolled = np.zeros(len(h) - n + 1, dtype=U64)
        for k in range(n):
            rolled += h[k : k + len(rolled)] * coef[k]
        begin = np.flatnonzero(count >= n)
        take = np.repeat(first[:-1][begin] - out_at[:-1][begin], each[begin])
        to = np.flatnonzero(np.repeat(count >= n, each))
        out[to] = rolled[to + take]
    for m in range(1, n):
        short = np.flatnonzero(count == m)
        if len(short):
            s = np.full(len(short), U64(m) * U64(STREAMS[3]), dtype=U64)
            for k in range(m):
                s += h[first[:-1][short] + k] * coef[k]
            out[out_at[:-1][short]] = s
    return mix(out ^ U64(STREAMS[0]))


def shingle_hashes(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit hashes (two arrays) of the n-word shingles of each text (A-Z lower-cased), with repeats, and n + 1 offsets.

    A text with fewer than n words, but one at least, has its whole sequence as one shingle; one without words none.
    """
    data, offsets = raw(column)
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    count = np.diff(first)
    each = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    out_at = np.concatenate(([0], np.cumsum(each)))
    if not len(starts):
        return np.zeros(0, U64), np.zeros(0, U64), out_at
    return *(_window(h, first, count, out_at, n) for h in range_hashes(data, starts, ends)), out_at


def distinct(h: np.ndarray, also: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's hashes sorted and without repeats, what stands beside them, and the offsets."""
    order = np.concatenate([np.zeros(0, np.int64), *[lo + np.argsort(h[lo:hi]) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist())]])
    h, row = h[order], np.repeat(np.arange(len(at) - 1), np.diff(at))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], also[order[new]], np.concatenate(([0], np.cumsum(new)))[at]


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of each range; ranges may be empty."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)))
    return total[at[1:]] - total[at[:-1]]


def lines(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Every line of every text (split at \\n; an empty text is one empty line).

    Gives: row of each line, its number in the text, code points of its key (white stripped at both ends), start and end
    of the key in the data, and the data with A-Z lower-cased.
    """
    data, offsets = raw(column)
    n_text = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    per = np.diff(np.searchsorted(breaks, offsets)) + 1
    row = np.repeat(np.arange(n_text), per)
    first_line = np.concatenate(([0], np.cumsum(per)))
    number = np.arange(first_line[-1]) - np.repeat(first_line[:-1], per)
    starts = np.empty(first_line[-1], dtype=np.int64)
    ends = np.empty(first_line[-1], dtype=np.int64)
    is_first = number == 0
    starts[is_first] = offsets[:-1]
    starts[~is_first] = breaks + 1
    is_last = np.zeros(len(starts), dtype=bool)
    is_last[first_line[1:] - 1] = True
    ends[is_last] = offsets[1:]
    ends[~is_last] = breaks
    solid = np.flatnonzero(~WHITE[data])
    lo = np.searchsorted(solid, starts)
    hi = np.searchsorted(solid, ends)
    some = hi > lo
    a = np.where(some, solid[np.minimum(lo, max(len(solid) - 1, 0))] if len(solid) else 0, starts)
    b = np.where(some, (solid[np.maximum(hi - 1, 0)] if len(solid) else 0) + 1, starts)
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    points = heads[b] - heads[a]
    return row, number, points, a, b, LOWER[data]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each character of valid UTF-8 begins, and its code point."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    b0 = data[lead]
    cp = b0.astype(np.int32)
    wide = np.flatnonzero(b0 >= 0x80)
    if len(wide):
        at, first = lead[wide], b0[wide].astype(np.int32)
        padded = np.concatenate((data, np.zeros(3, np.uint8)))
        c1, c2, c3 = (padded[at + k].astype(np.int32) & 0x3F for k in (1, 2, 3))
        two = ((first & 0x1F) << 6) | c1
        three = ((first & 0x0F) << 12) | (c1 << 6) | c2
        four = ((first & 0x07) << 18) | (c1 << 12) | (c2 << 6) | c3
        cp[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
    return lead, cp
