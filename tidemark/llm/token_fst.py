"""Token counts by a compiled finite-state transducer, without making the tokens.

A byte-level BPE vocabulary is compiled into two deterministic machines.

1. Pieces. The pattern that splits text (letters, numbers, other, white space, contractions) reads classes of characters
   and needs one character of context on either side, so piece starts are computed for all characters of a slice at once.
2. Tokens of a piece. While bytes are read, exactly one token can end the encoding of what has been read: the one
   that is a suffix of it and whose pair with the token that ends the encoding before it would stay unmerged. A state
   holds the longest suffix that can still grow into a token and, for each place within it, the token that ends there
   and the count of tokens so far, relative to now. A transition is annotated with the change in the number of emitted
   tokens (it may be negative, when a byte lets tokens merge). States and transitions are compiled when first met and
   kept in a dense table (states x byte classes); past MAX_STATES the table starts anew.

Pieces are lanes that step through the table together. A piece longer than CHUNK bytes is cut into chunks, each of which
has a map from entry states to (exit state, count). Its entries are the states that run-ups of several lengths end in, and every
exit in the map of the chunk before; so the maps of a piece can be composed from its first state on. They are composed for
all chunks at once by a parallel prefix scan, which doubles the stretch that each map covers in every step.

Strings of the vocabulary's added tokens are matched first, as the library does by default, and count as one token each.

Nulls, ties, repeats: a null or empty text has 0 bytes and 0 tokens; every row is counted on its own, null or repeated ids
included; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm import scan
from tidemark.llm.bpe_codec import byte_characters
from tidemark.llm.common import narrow, ship, steps

MAX_STATES = 1 << 18
CHUNK = 256
RUN_UPS = (64, 63, 61, 48)
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: What follows an apostrophe in a contraction.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def character_classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, text):
            lo, hi = ord(text[m.start()]), ord(text[m.end() - 1])
            out[lo : hi + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


class Transducer:
    """Counts BPE tokens of byte strings that are pieces."""

    def __init__(self, tokens: dict[bytes, int], ranks: dict[tuple[bytes, bytes], int]):
        self.tokens, self.ranks = tokens, ranks
        self.growing = {t[:k] for t in tokens for k in range(1, len(t))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.column = np.full(256, -1, dtype=np.int32)
        self.bytes: list[int] = []
        self.gains = np.int8 if max(map(len, tokens)) <= 128 else np.int32  # a change is at most 1 and at least 1 - the longest token
        self._reset(128)

    def _reset(self, width: int) -> None:
        self.width = width
        self.next = np.zeros((MAX_STATES + 4096, width), dtype=np.int32)  # 1 + state; 0: not compiled. Pages are touched as states come.
        self.gain = np.zeros((MAX_STATES + 4096, width), dtype=self.gains)
        self.states: dict = {}
        self.keys: list = []
        self._state((b"", (None,), (0,)))

    def _state(self, key) -> int:
        s = self.states.get(key)
        if s is None:
            s = self.states[key] = len(self.keys)
            self.keys.append(key)
            if s >= len(self.next):
                more = len(self.next)
                self.next = np.vstack((self.next, np.zeros((more, self.width), dtype=np.int32)))
                self.gain = np.vstack((self.gain, np.zeros((more, self.width), dtype=self.gains)))
        return s

    def bpe(self, data: bytes) -> list[bytes]:
        """Merges by rank, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get((parts[i], parts[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays(self, left: bytes | None, right: bytes) -> bool:
        """Whether the two tokens, one after the other, are what their bytes are encoded as."""
        if left is None:
            return True
        key = (left, right)
        ok = self.pairs.get(key)
        if ok is None:
            ok = self.pairs[key] = self.bpe(left + right) == [left, right]
        return ok

    def _compile(self, s: int, byte: int) -> None:
        """The transition of a state on a byte. A key is (window, last token at each place of it, counts less that of now)."""
        window, last, count = self.keys[s]
        grown = window + bytes((byte,))
        end = None
        for i in range(len(grown)):
            t = grown[i:]
            if t in self.tokens and self.stays(last[i], t):
                end, gain = t, count[i] + 1
                break
        if end is None:
            raise ValueError(f"no token ends with byte {byte}")
        cut = next((i for i in range(len(grown)) if grown[i:] in self.growing), len(grown))
        key = (grown[cut:], (*last[cut:], end), tuple(c - gain for c in count[cut:]) + (0,))
        to = self._state(key)
        self.next[s, self.column[byte]] = to + 1
        self.gain[s, self.column[byte]] = gain

    def _columns(self, data: np.ndarray) -> np.ndarray:
        new = [b for b in np.flatnonzero(np.bincount(data, minlength=256)).tolist() if self.column[b] < 0]
        for b in new:
            self.column[b] = len(self.bytes)
            self.bytes.append(b)
        if len(self.bytes) > self.width:
            wider = min(256, max(2 * self.width, len(self.bytes)))
            more = wider - self.width
            self.next = np.hstack((self.next, np.zeros((len(self.next), more), dtype=np.int32)))
            self.gain = np.hstack((self.gain, np.zeros((len(self.gain), more), dtype=self.gains)))
            self.width = wider
        return self.column[data]

    def step(self, state: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and changes of the count, for lanes at these states reading these byte columns."""
        to = self.next[state, col]
        missing = np.flatnonzero(to == 0)
        if len(missing):
            for k in np.unique(state[missing].astype(np.int64) * 256 + col[missing]).tolist():
                self._compile(k >> 8, self.bytes[k & 255])
            to = self.next[state, col]
        return to - 1, self.gain[state, col]

    def run(self, cols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit state and count of each lane."""
        order = np.argsort(-lengths, kind="stable")
        at, n = starts[order], lengths[order]
        now, total = state[order].astype(np.int32), np.zeros(len(order), dtype=np.int64)
        longest = int(n[0]) if len(n) else 0
        active = np.searchsorted(-n, -np.arange(longest), side="left")  # lanes longer than k
        for k in range(longest):
            a = int(active[k])
            to, gain = self.step(now[:a], cols[at[:a] + k])
            now[:a] = to
            total[:a] += gain
        out_state, out_total = np.empty_like(now), np.empty_like(total)
        out_state[order], out_total[order] = now, total
        return out_state, out_total

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each piece."""
        if not len(starts):
            return np.zeros(0, dtype=np.int64)
        if len(self.keys) > MAX_STATES:
            self._reset(self.width)
            self.pairs.clear()
        cols = self._columns(data)
        lengths = ends - starts
        long = np.flatnonzero(lengths > CHUNK)
        short = np.flatnonzero(lengths <= CHUNK)
        out = np.zeros(len(starts), dtype=np.int64)
        out[short] = self.run(cols, starts[short], lengths[short], np.zeros(len(short), np.int32))[1]
        if len(long):
            out[long] = self._chunked(cols, starts[long], lengths[long])
        return out

    def _chunked(self, cols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of long pieces: the chunks' maps, for all pieces at once, composed by a prefix scan."""
        per = -(-lengths // CHUNK)
        piece = np.repeat(np.arange(len(starts)), per)
        first = np.cumsum(per) - per
        number = np.arange(len(piece)) - first[piece]
        at = starts[piece] + number * CHUNK
        n = np.minimum(CHUNK, lengths[piece] - number * CHUNK)
        final = number == per[piece] - 1
        chunk, entry, leave, count = self._maps(cols, at, n, number, final)
        # an entry of a map points to the entry of the next map that it leaves by; behind the last map is nothing to count
        key = chunk << 32 | entry
        after = np.where(final[chunk], len(key), np.searchsorted(key, (chunk + 1) << 32 | leave))
        after, total = np.append(after, len(key)), np.append(count, 0)
        while (after != len(key)).any():
            total += total[after]
            after = after[after]
        return total[np.searchsorted(key, first << 32)]

    def _maps(self, cols, at, n, number, final) -> tuple[np.ndarray, ...]:
        """Entries of the maps, ordered by chunk and entry state: chunk, entry state, exit state, count."""
        every = np.arange(len(at))
        zero = np.zeros(len(at), dtype=np.int32)
        suggested = [np.where(number == 0, 0, self.run(cols, at - up, up, zero)[0]) for up in (np.minimum(r, number * CHUNK) for r in RUN_UPS)]
        due = np.unique(np.concatenate([every << 32 | s for s in suggested]))
        known, leave, count = (np.zeros(0, dtype=np.int64) for _ in range(3))
        while len(due):
            chunk, entry = due >> 32, due & 0xFFFFFFFF
            to, gain = self.run(cols, at[chunk], n[chunk], entry)
            known, leave, count = (np.concatenate(x) for x in ((known, due), (leave, to), (count, gain)))
            on = ~final[chunk]
            due = np.setdiff1d((chunk[on] + 1) << 32 | to[on], known)
        order = np.argsort(known)
        return known[order] >> 32, known[order] & 0xFFFFFFFF, leave[order], count[order]


def check(spec: dict, path: str) -> None:
    """Refuses a file that asks for more than byte-level BPE with the built-in split: its counts would be wrong without a word."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    odd = [f"model.{k}" for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += [] if model.get("type", "BPE") == "BPE" else ["model.type"]
    odd += ["normalizer"] if spec.get("normalizer") else []
    odd += [] if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True) else ["pre_tokenizer"]
    odd += [f"added token {t['content']!r}" for t in spec["added_tokens"] if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
    if odd:
        raise ValueError(f"{path} isn't a plain byte-level BPE: {', '.join(odd)}")


class Counter:
    """Token counts of texts by the vocabulary file of a byte-level BPE tokenizer (JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check(spec, path)
        back = {c: b for b, c in enumerate(byte_characters())}
        raw = lambda t: bytes(back[c] for c in t)
        self.added = sorted((t["content"].encode() for t in spec["added_tokens"]), key=len, reverse=True)
        known = {t["content"] for t in spec["added_tokens"]}
        tokens = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in known}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.transducer = Transducer(tokens, {(raw(a), raw(b)): r for r, (a, b) in enumerate(merges)})
        self.classes = character_classes()

    def segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of segments: texts, cut at added tokens; and which segments are added tokens."""
        cuts, special = offsets[1:], np.zeros(len(offsets) - 1, dtype=bool)
        text, found = data.tobytes(), []
        if not any(a in text for a in self.added):
            return cuts, special
        places = regex.compile(b"|".join(regex.escape(a) for a in self.added))
        for m in places.finditer(text):
            if offsets[np.searchsorted(offsets, m.start(), "right")] >= m.end():
                found.append((m.start(), m.end()))
        ends = np.concatenate((cuts, [a for a, _ in found], [b for _, b in found])).astype(np.int64)
        kind = np.concatenate((special, np.zeros(len(found), bool), np.ones(len(found), bool)))
        order = np.lexsort((~kind, ends))  # what ends where a special segment ends is empty and comes after it
        return ends[order], kind[order]

    def piece_starts(self, data: np.ndarray, bounds: np.ndarray, special: np.ndarray) -> np.ndarray:
        """Where pieces begin, in order. bounds: starts of segments that hold bytes; special: those that are one piece."""
        lead, cp = scan.code_points(data)
        kind = self.classes[cp]
        n = len(cp)
        seg = np.zeros(n, dtype=bool)  # a segment begins here
        seg[np.searchsorted(lead, bounds)] = True
        change = np.ones(n, dtype=bool)
        change[1:] = (kind[1:] != kind[:-1]) | seg[1:]
        final = np.ones(n, dtype=bool)  # the last of its run
        final[:-1] = change[1:]
        at_end = np.ones(n, dtype=bool)  # the last of its segment
        at_end[:-1] = seg[1:]
        blank = kind == SPACE
        plain = cp == 0x20
        start = change & blank
        start |= blank & final & ~at_end  # the last white character before something else
        after_space = np.zeros(n, dtype=bool)
        after_space[1:] = plain[:-1] & ~seg[1:]
        start |= change & ~blank & ~after_space
        start |= seg
        # contractions: an apostrophe alone before letters, where a piece begins
        quote = np.flatnonzero((cp == 0x27) & start & final & change)
        quote = quote[quote + 1 < n]
        quote = quote[(kind[quote + 1] == LETTER) & ~seg[quote + 1]]
        if len(quote):
            tail = np.concatenate((cp, [0, 0]))
            same = np.concatenate((seg, [True, True]))
            one, two = tail[quote + 1], np.where(same[quote + 2], 0, tail[quote + 2])
            for c in CONTRACTIONS:
                hit = one == ord(c[0]) if len(c) == 1 else (one == ord(c[0])) & (two == ord(c[1]))
                q = quote[hit]
                start[q + 1] = False
                after = q + 1 + len(c)
                after = after[after < n]
                start[after] = True
        if special.any():
            order = np.searchsorted(bounds, lead, side="right") - 1
            start[special[order] & ~seg] = False
        return lead[start]

    def count(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text."""
        data, offsets = scan.raw(column)
        size = np.diff(offsets)
        if not len(data):
            return size, np.zeros(len(size), dtype=np.int64)
        ends, special = self.segments(data, offsets)
        begins = np.concatenate(([0], ends[:-1]))
        some = ends > begins
        bounds, kinds = begins[some], special[some]
        starts = self.piece_starts(data, bounds, kinds)
        stops = np.concatenate((starts[1:], [len(data)]))
        whole = np.zeros(len(starts), dtype=bool)
        if kinds.any():
            whole[np.searchsorted(starts, bounds[kinds])] = True
        tokens = np.ones(len(starts), dtype=np.int64)
        tokens[~whole] = self.transducer.counts(data, starts[~whole], stops[~whole])
        return size, scan.sums(tokens, np.searchsorted(starts, offsets))


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One per worker process and file."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def _count(path: str, limit: int):
    def run(batches):
        c = counter(path)
        for whole in batches:
            for b in steps(whole):
                size, tokens = c.count(b.column("text"))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size), pa.array(tokens), pa.array(tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    ship(docs.sparkSession)
    slim = narrow(docs, doc_id=id_col, text=text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(_count(path, limit), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
