"""N-gram Jaccard join: a grouped prefix join over word shingles, exact, with components of the links.

A document's set is its distinct n-word shingles (A-Z lower-cased), hashed to 128 bits: the key of a set, which decides which
sets are equal, is made of all of them, and pairs are compared by the first 64. Two link when 100 * intersection >=
percent * union. The order of tokens that prefixes follow is (estimated document frequency, hash): the estimate comes
from one counter array of fixed size over all texts, and any order gives the same links; rare tokens first keeps
passages that very many documents share out of prefixes.

1. `_counts`: one pass over the texts counts tokens into 2^COUNTER_BITS counters (fixed size, so it may be broadcast).
2. `_profiles`: a second pass gives each row its set's 128-bit key, size and prefix, written once. Rows with equal sets
   become one class (exact copies cost no comparison); classes with equal size and prefix become one group.
3. The groups' prefix tokens are partitioned and sorted by token; a streaming pass keeps those that some other group of
   the token's run passes the size and position filters with.
4. Star rounds: in each token's run, and each group, members are compared with an anchor of their own size band and of
   the band below (one or two candidates a row, whatever the run's length), and links are joined into components.
   Further rounds, with other anchors, follow while more pairs are left than there are prefix rows.
5. Last round: group pairs that pass the size, position and overlap filters and are not of one component already are
   expanded to their members, and those of different components are compared. No pair of different texts that could link
   is left out: it is either compared or joined already. In a family of near copies the stars join nearly all
   members, so all pairs within it are never made.
6. Pairs whose parity bits (PARITY_BITS for each set) differ in too many places cannot overlap enough and go. Comparison
   of the rest needs whole sets: a third pass makes those of candidate classes only (chosen by a filter of 2^FILTER_BITS
   bits, fixed size), and pairs meet them by joins that Spark may split when skewed.

Nulls, ties, repeats: a null or empty text, or one without words, has an empty set and links with nothing; its component
is its own id. With fewer than n words the whole sequence is one shingle. Rows that repeat an id are rows of their own in
the join, and a component's id is the smallest id in it (null only if all are null). An empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scan
from tidemark.llm.common import dropped, lean, narrow, release, steps, written
from tidemark.llm.components import components

COUNTER_BITS = 22
CHUNK_BITS = 16
FAN_IN = 32
FILTER_BITS = 24
PARITY_BITS = 1024
#: Star rounds are repeated while more crossing pairs than prefix rows are left, so often at most; then all are compared.
MOST_ROUNDS = 6
#: Longer runs of a token are passed on whole.
LONG_RUN = 1024
#: Rows of a slice, at least: runs of a token and groups that are longer are cut up and dealt to several tasks.
SLICE_ROWS = 512
U64 = scan.U64


def _count_tokens(n: int):
    @lean
    def run(batches):
        total = np.zeros(1 << COUNTER_BITS, dtype=np.uint32)
        for whole in batches:
            for b in steps(whole):
                h, _, _ = scan.distinct(*scan.shingle_hashes(b.column("text"), n))
                np.add.at(total, (h >> U64(64 - COUNTER_BITS)).astype(np.int64), np.uint32(1))
        yield from _chunks(enumerate(total.reshape(-1, 1 << CHUNK_BITS)))

    return run


def _chunks(counters):
    """Rows for chunks of counters that aren't all 0, each in the narrowest type, and the task they come from."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    for i, x in counters:
        if top := int(x.max()):
            kind = np.min_scalar_type(top)
            cols = [pa.array([part], pa.int32()), pa.array([i], pa.int32()), pa.array([kind.itemsize], pa.int32()), pa.array([x.astype(kind).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["part", "chunk", "width", "counts"])


@lean
def _add_counts(batches):
    """Streams; holds one chunk of counters for each chunk number of its partition."""
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for chunk, width, raw in zip(b.column("chunk").to_pylist(), b.column("width").to_pylist(), b.column("counts")):
            x = np.frombuffer(raw.as_buffer(), f"<u{width}").astype(np.uint64)
            held[chunk] = held[chunk] + x if chunk in held else x
    yield from _chunks((i, np.minimum(held[i], (1 << 32) - 1)) for i in sorted(held))


def _counts(texts: DataFrame, n: int) -> np.ndarray:
    """Document frequencies by the first COUNTER_BITS bits of the hash. What reaches the driver has a fixed size.

    Added up in two steps, FAN_IN tasks at a time first, so that no task reads what all others wrote.
    """
    schema = "part int, chunk int, width int, counts binary"
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = 1 << (COUNTER_BITS - CHUNK_BITS)
    some = texts.select("text").mapInArrow(_count_tokens(n), schema)
    some = some.repartition(parts, "chunk", F.floor(F.col("part") / FAN_IN)).mapInArrow(_add_counts, schema)
    added = some.repartition(max(1, chunks // 4), "chunk").mapInArrow(_add_counts, schema)
    out = np.zeros((chunks, 1 << CHUNK_BITS), dtype=np.uint32)
    for r in added.collect():
        out[r["chunk"]] = np.frombuffer(r["counts"], f"<u{r['width']}")
    return out.reshape(-1)


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    """size - ceil(percent / 100 * size) + 1"""
    return size - (percent * size + 99) // 100 + 1


def set_key(h: np.ndarray, also: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit key of each set: sums of the mixed tokens, from either half of their hashes."""
    return tuple(scan.mix(scan.sums(scan.mix(x ^ U64(s)), at) + np.diff(at).astype(U64)).view(np.int64) for x, s in zip((h, also), scan.STREAMS[1:3]))


def parities(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of bits for each set: whether an odd number of its tokens falls on each of PARITY_BITS places."""
    rows = len(at) - 1
    place = (scan.mix(h ^ U64(scan.STREAMS[3])) >> U64(32)) % U64(PARITY_BITS)
    place = place.astype(np.int64) + np.repeat(np.arange(rows), np.diff(at)) * PARITY_BITS
    odd = np.bincount(place, minlength=rows * PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(rows, PARITY_BITS), axis=1)


def _by_parity(percent: int):
    """Pairs whose sets can overlap enough: they differ in at least as many tokens as their parities differ in bits."""

    @lean
    def run(batches):
        names = ["a", "b", "a1", "a2", "b1", "b2"]
        for b in batches:
            na, nb = (b.column(c).to_numpy().astype(np.int64) for c in ("an", "bn"))
            pa_, pb = (np.frombuffer(scan.raw(b.column(c))[0].tobytes(), np.uint8).reshape(-1, PARITY_BITS // 8) for c in ("ap", "bp"))
            differ = np.bitwise_count(pa_ ^ pb).sum(axis=1, dtype=np.int64)
            keep = pa.array(na + nb - differ >= 2 * least_overlap(na, nb, percent))
            yield pa.RecordBatch.from_arrays([b.column(c).filter(keep) for c in names], names=names)

    return run


def _profile(n: int, percent: int, counts, tags: list[str]):
    @lean
    def run(batches):
        freq = counts.value
        for whole in batches:
            for b in steps(whole):
                h, also, at = scan.distinct(*scan.shingle_hashes(b.column("text"), n))
                size = np.diff(at)
                k1, k2 = set_key(h, also, at)
                order = np.lexsort((h, freq[(h >> U64(64 - COUNTER_BITS)).astype(np.int64)], np.repeat(np.arange(len(size)), size)))
                ranked = h[order]
                p = np.where(size > 0, prefix_length(size, percent), 0)
                out = [ranked[a : a + k].tobytes() for a, k in zip(at[:-1].tolist(), p.tolist())]
                inside = np.arange(len(ranked)) - np.repeat(at[:-1], size) < np.repeat(p, size)
                p1, p2 = set_key(ranked[inside], also[order][inside], np.concatenate(([0], np.cumsum(p))))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc", *tags)], pa.array(k1), pa.array(k2), pa.array(size.astype(np.int32)), pa.array(p1), pa.array(p2), pa.array([x.tobytes() for x in parities(h, at)], pa.binary()), pa.array(out, pa.binary())], names=["doc", *tags, "k1", "k2", "n", "p1", "p2", "parity", "prefix"])

    return run


def _explode(counts, slice_rows: int):
    """token, g, n, pos of every group's prefix; slices: how many its token's run is cut into.

    The counters bound a run from above, so that a slice has about slice_rows rows at most.
    """

    @lean
    def run(batches):
        freq = counts.value
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                data, at = scan.raw(part.column("prefix").cast(pa.binary()))
                each = np.diff(at) // 8
                tokens = np.frombuffer(data.tobytes(), dtype=np.int64)
                row = pa.array(np.repeat(np.arange(part.num_rows), each))
                pos = np.arange(len(tokens)) - np.repeat(np.cumsum(each) - each, each)
                slices = -(-freq[(tokens.view(U64) >> U64(64 - COUNTER_BITS)).astype(np.int64)].astype(np.int64) // slice_rows)
                yield pa.RecordBatch.from_arrays([pa.array(tokens), part.column("g").take(row), part.column("n").take(row), pa.array(pos.astype(np.int32)), pa.array(np.maximum(slices, 1).astype(np.int32))], names=["token", "g", "n", "pos", "slices"])

    return run


def _runs_by_size(starts: np.ndarray, sizes: np.ndarray):
    """Runs of equal length together, as rows of places."""
    for k in np.unique(sizes).tolist():
        if k > 1:
            at = starts[sizes == k]
            for lo in range(0, len(at), max(1, (1 << 18) // (k * k))):
                yield at[lo : lo + max(1, (1 << 18) // (k * k)), None] + np.arange(k)


def _shared(percent: int):
    """Of a partition sorted by token, the rows that some other row of their run passes the filters with.

    Runs of more than LONG_RUN rows are passed on whole, as they come, and so are rows of sliced runs; others are held until
    they end.
    """

    def feasible(rows: pa.RecordBatch, starts: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        n, pos = rows.column("n").to_numpy().astype(np.int64), rows.column("pos").to_numpy().astype(np.int64)
        sliced = rows.column("slices").to_numpy() > 1
        keep = np.zeros(rows.num_rows, dtype=bool)
        light = ~sliced[starts] if len(starts) else np.zeros(0, bool)
        for at in _runs_by_size(starts[light], sizes[light]):
            ok = possible(n[at][:, :, None], pos[at][:, :, None], n[at][:, None, :], pos[at][:, None, :], percent)
            ok[:, np.arange(at.shape[1]), np.arange(at.shape[1])] = False
            keep[at] = ok.any(axis=2)
        return rows.filter(pa.array(keep | sliced))

    @lean
    def run(batches):
        held, passing = None, None
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
                held = None
            t = b.column("token").to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            sizes = np.diff(np.append(starts, len(t)))
            if passing is not None and t[0] == passing:
                yield b.slice(0, sizes[0])
                if len(starts) == 1:
                    continue
                b, t = b.slice(sizes[0]), t[sizes[0] :]
                starts, sizes = starts[1:] - sizes[0], sizes[1:]
            last = int(starts[-1])
            passing = t[-1] if len(t) - last > LONG_RUN else None
            if passing is not None:
                yield b.slice(last)
            else:
                held = b.slice(last)
            whole = sizes[:-1]
            for k in np.flatnonzero(whole > LONG_RUN).tolist():
                yield b.slice(int(starts[k]), int(whole[k]))
            small = whole <= LONG_RUN
            yield feasible(b.slice(0, last), starts[:-1][small], whole[small])
        if held is not None:
            yield feasible(held, np.zeros(1, np.int64), np.array([held.num_rows]))

    return run


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The smallest intersection that lets sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def possible(na, pa_, nb, pb, percent: int) -> np.ndarray:
    """Size and position filter for a shared token at these places. (A linking pair passes it at its first shared token.)"""
    need = least_overlap(na, nb, percent)
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (np.minimum(na - pa_, nb - pb) >= need)


def _stars(percent: int):
    """Of a partition sorted by token, slice, band and mark: each row with the first of its band and the first of the band
    below. State between batches: two anchors. A row's component is that of its group's leader."""

    @lean
    def run(batches):
        cell = None
        anchors: dict[int, tuple] = {}
        names = ["a", "b"]
        for batch in batches:
            if not batch.num_rows:
                continue
            t, k, g, n, pos, comp, bands = (batch.column(c).to_numpy() for c in ("token", "slice", "g", "n", "pos", "comp", "band"))
            head = np.ones(len(t), dtype=bool)
            head[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1]) | (bands[1:] != bands[:-1])
            starts = np.flatnonzero(head)
            run_of = np.cumsum(head) - 1
            # anchor of each (token, slice, band) run: its first row, or that of an earlier batch
            ag, an, ap, ac = g[starts].copy(), n[starts].copy(), pos[starts].copy(), comp[starts].copy()
            rt, rk, rb = t[starts], k[starts], bands[starts]
            same = (rt[1:] == rt[:-1]) & (rk[1:] == rk[:-1])
            if cell == (rt[0], rk[0]) and int(rb[0]) in anchors:
                ag[0], an[0], ap[0], ac[0] = anchors[int(rb[0])]
            out_a, out_b = [], []

            def pair(rows, which):
                ok = (comp[rows] != ac[which]) & (g[rows] != ag[which]) & possible(n[rows].astype(np.int64), pos[rows], an[which].astype(np.int64), ap[which], percent)
                out_a.append(g[rows][ok])
                out_b.append(ag[which][ok])

            every = np.arange(len(t))
            pair(every, run_of)
            below = np.full(len(starts), -1)
            has = np.flatnonzero(same & (rb[1:] == rb[:-1] + 1)) + 1
            below[has] = has - 1
            rows = every[below[run_of] >= 0]
            pair(rows, below[run_of[rows]])
            if cell == (rt[0], rk[0]) and int(rb[0]) - 1 in anchors:
                bg, bn, bp, bc = anchors[int(rb[0]) - 1]
                rows = every[run_of == 0]
                ok = (comp[rows] != bc) & (g[rows] != bg) & possible(n[rows].astype(np.int64), pos[rows], np.int64(bn), bp, percent)
                out_a.append(g[rows][ok])
                out_b.append(np.full(int(ok.sum()), bg))
            last = len(starts) - 1
            kept = {}
            if last and same[-1]:
                kept[int(rb[last - 1])] = (ag[last - 1], an[last - 1], ap[last - 1], ac[last - 1])
            elif cell == (rt[last], rk[last]) and not last:
                kept = {band: v for band, v in anchors.items() if band >= int(rb[last]) - 1}
            kept[int(rb[last])] = (ag[last], an[last], ap[last], ac[last])
            cell, anchors = (rt[last], rk[last]), kept
            a, b = np.concatenate(out_a), np.concatenate(out_b)
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            if len(lo):
                u = np.unique(np.column_stack((lo, hi)), axis=0)
                lo, hi = u[:, 0], u[:, 1]
            yield pa.RecordBatch.from_arrays([pa.array(lo), pa.array(hi)], names=names)

    return run


def _blocks(rows: DataFrame) -> DataFrame:
    """Every row once for each pair of slices that its own is in, so that all pairs of a run meet in some block (i <= j), and no
    block holds more than two slices: i, j."""
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    out = rows.select("*", other.alias("other"))
    return out.select(*rows.columns, F.least("slice", "other").alias("i"), F.greatest("slice", "other").alias("j"))


def _cells(batches, read, keys: int, dull=None):
    """The rows of each cell of a partition sorted by cell, as arrays. read: arrays of a batch, the first `keys` of which name
    the cell. dull: tells, for all cells that lie inside a batch, which of them aren't wanted."""
    held: list[list[np.ndarray]] = []

    def joined():
        return held[0] if len(held) == 1 else [np.concatenate(x) for x in zip(*held)]

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = read(batch)
        new = np.zeros(batch.num_rows, dtype=bool)
        for k in cols[:keys]:
            new[1:] |= k[1:] != k[:-1]
        if held and any(h[-1] != c[0] for h, c in zip(held[-1][:keys], cols[:keys])):
            yield joined()
            held = []
        starts = np.concatenate(([0], np.flatnonzero(new)))
        stops = np.append(starts[1:], batch.num_rows)
        wanted = np.ones(len(starts), dtype=bool) if dull is None else ~dull(cols, starts)
        if len(starts) > 1 and held:
            held.append([c[: stops[0]] for c in cols])
            yield joined()
            held, wanted[0] = [], False
        for at in np.flatnonzero(wanted[:-1]).tolist():
            yield [c[starts[at] : stops[at]] for c in cols]
        held.append([c[starts[-1] :] for c in cols])
    if held:
        yield joined()


def _upper_pairs(each: np.ndarray, chunk: int = 1 << 20):
    """Pairs (i, i + 1 .. i + each[i]) of places, about `chunk` at a time."""
    done = np.concatenate(([0], np.cumsum(each)))
    at = 0
    while at < len(each):
        to = max(at + 1, int(np.searchsorted(done, done[at] + chunk, side="right")) - 1)
        i = np.repeat(np.arange(at, to), each[at:to])
        yield i, np.arange(len(i)) - np.repeat(done[at:to] - done[at], each[at:to]) + i + 1
        at = to


def _crossings(percent: int):
    """Of a partition sorted by token and block: all group pairs of a block that pass the filters and are not of one component
    (mixed groups, component -1, are paired with all), with the room left after the token and the overlap needed. Memory
    holds a block's rows; blocks of one component are skipped."""

    @lean
    def run(batches):
        read = lambda batch: [batch.column(c).to_numpy() for c in ("token", "i", "j", "slice", "g", "n", "pos", "comp")]

        def dull(cols, starts):
            low, high = np.minimum.reduceat(cols[7], starts), np.maximum.reduceat(cols[7], starts)
            return (low == high) & (low >= 0)

        for _, first, second, own, g, n, pos, comp in _cells(batches, read, 3, dull):
            if len(comp) < 2 or (comp[0] >= 0 and (comp == comp[0]).all()):
                continue
            across = first[0] != second[0]
            order = np.argsort(n, kind="stable")
            own, g, n, pos, comp = own[order], g[order], n[order].astype(np.int64), pos[order].astype(np.int64), comp[order]
            top = np.searchsorted(n, 100 * n // percent, side="right")  # partners lie after a row, up to this place
            for i, j in _upper_pairs(top - np.arange(len(n)) - 1):
                ok = ((comp[i] != comp[j]) | (comp[i] < 0)) & possible(n[i], pos[i], n[j], pos[j], percent)
                if across:
                    ok &= own[i] != own[j]
                i, j = i[ok], j[ok]
                if len(i):
                    turn = g[i] > g[j]
                    a, b = np.where(turn, j, i), np.where(turn, i, j)
                    room = np.minimum(n[a] - pos[a], n[b] - pos[b]) - 1  # tokens that may still be shared after this one
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (g[a], g[b], room, least_overlap(n[a], n[b], percent))], names=["ga", "gb", "room", "need"])

    return run


def _inside(percent: int):
    """Of a partition of members sorted by group and block: the pairs of a block that are of different components and whose
    parities let them overlap enough. Other pairs are never made into rows."""

    @lean
    def run(batches):
        def read(batch):
            bits = np.frombuffer(scan.raw(batch.column("parity"))[0].tobytes(), "<u8").reshape(batch.num_rows, -1)
            return [*[batch.column(c).to_numpy() for c in ("g", "i", "j", "slice", "c", "comp", "n")], bits]

        for _, first, second, own, c, comp, n, bits in _cells(batches, read, 3):
            across = first[0] != second[0]
            most = 2 * (n[0].astype(np.int64) - least_overlap(n[0].astype(np.int64), n[0].astype(np.int64), percent))
            for i, j in _upper_pairs(len(c) - 1 - np.arange(len(c)), 1 << 16):
                ok = comp[i] != comp[j]
                if across:
                    ok &= own[i] != own[j]
                i, j = i[ok], j[ok]
                near = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64) <= most
                a, b = c[i[near]], c[j[near]]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return run


def _verify(percent: int):
    @lean
    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column("set_a"), b.column("set_b")):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])

    return run


def _filter_place(k1, k2, doc):
    """The place of a row, by set and id, in the filter of candidates."""
    x = k1.view(U64) ^ scan.mix(k2.view(U64) + scan.mix(doc.astype(np.int64).view(U64)))
    return (scan.mix(x) >> U64(64 - FILTER_BITS)).astype(np.int64)


@lean
def _filter_bits(batches):
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    for b in batches:
        bits[_filter_place(b.column("k1").to_numpy(), b.column("k2").to_numpy(), b.column("doc").to_numpy())] = True
    if bits.any():
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], names=["chunk", "bits"])


@lean
def _or_bits(batches):
    total = None
    for b in batches:
        for z in b.column("bits").to_pylist():
            x = np.frombuffer(zlib.decompress(z), np.uint8)
            total = x if total is None else total | x
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["chunk", "bits"])


def _candidate_filter(keys: DataFrame) -> bytes:
    """Bits of all candidate sets, FILTER_BITS places whatever their number."""
    schema = "chunk int, bits binary"
    found = keys.mapInArrow(_filter_bits, schema).repartition(16).mapInArrow(_or_bits, schema).collect()
    total = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    for r in found:
        total |= np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return total.tobytes()


def _sets(n: int, bits):
    """k1, k2, set of the rows that are in the filter: one row of each candidate class, and few others."""

    @lean
    def run(batches):
        member = np.unpackbits(np.frombuffer(bits.value, np.uint8)).astype(bool)
        for whole in batches:
            for b in steps(whole):
                h, also, at = scan.distinct(*scan.shingle_hashes(b.column("text"), n))
                k1, k2 = set_key(h, also, at)
                hit = np.flatnonzero(member[_filter_place(k1, k2, b.column("doc").to_numpy())] & (np.diff(at) > 0))
                out = pa.array([h[at[i] : at[i + 1]].tobytes() for i in hit.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(k1[hit]), pa.array(k2[hit]), out], names=["k1", "k2", "set"])

    return run


class Join:
    """The stages of one join; `result` gives a row for every input row."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80, tags: list[str] | None = None):
        """tags: long columns of docs that the result carries along."""
        self.tags = {f"tag{i}": t for i, t in enumerate(tags or [])}
        self.spark, self.n, self.percent = docs.sparkSession, n, percent
        self.docs = narrow(docs, doc=id_col, text=text_col, **self.tags).withColumn("doc", F.col("doc").cast("long"))
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def profiles(self) -> DataFrame:
        freq = _counts(self.docs, self.n)
        self.counts = self.spark.sparkContext.broadcast(freq)
        # a token counts as frequent well above the mean, which grows with the corpus
        self.slice_rows = max(SLICE_ROWS, 4 * int(freq.mean()))
        tags = "".join(f"{t} long, " for t in self.tags)
        found = self.docs.mapInArrow(_profile(self.n, self.percent, self.counts, list(self.tags)), f"doc long, {tags}k1 long, k2 long, n int, p1 long, p2 long, parity binary, prefix binary")
        return written(found.withColumn("row", F.monotonically_increasing_id()), "ngram-profiles")

    def _shared_tokens(self, leaders: DataFrame) -> DataFrame:
        """Prefix rows with a feasible partner; those of tokens that are cut into slices are passed on as they are."""
        schema = "token long, g long, n int, pos int, slices int"
        tokens = leaders.mapInArrow(_explode(self.counts, self.slice_rows), schema)
        # whole runs come together; the rows of sliced ones are dealt anywhere
        deal = F.when(F.col("slices") > 1, F.xxhash64("token", "g")).otherwise(F.col("token"))
        laid = tokens.repartition(self.parts, deal).sortWithinPartitions("token")
        shared = written(laid.mapInArrow(_shared(self.percent), schema), "ngram-shared")
        out = shared.withColumn("slice", F.pmod(F.xxhash64("g"), F.col("slices")).cast("int"))
        out._written_path = shared._written_path
        return out

    def result(self) -> DataFrame:
        """doc, n_shingles, component_id, root (one for each component), class_id (one for each set) and the tags."""
        profiles = self.profiles()
        sets = profiles.where("n > 0")
        classes = sets.groupBy("k1", "k2", "n", "p1", "p2", "parity").agg(F.min("row").alias("c"), F.min("doc").alias("doc"))
        classes = written(classes, "ngram-classes")
        groups = classes.groupBy("n", "p1", "p2").agg(F.min("c").alias("g"), F.count("*").alias("size"))
        groups = written(groups, "ngram-groups")
        leaders = groups.select("g").join(sets.select("row", "n", "prefix"), F.col("g") == F.col("row")).select("g", "n", "prefix")
        shared = self._shared_tokens(leaders)
        # groups of several classes: their members, by the leader
        members = written(classes.select("c", "n", "p1", "p2", "parity").join(groups.where("size > 1"), ["n", "p1", "p2"]).select("g", "c", "n", "parity", "size"), "ngram-members")
        # candidates: every class whose group shares a token, or its prefix, with another
        wanted = shared.select(F.col("g").alias("c")).unionByName(members.select("c")).distinct()
        keys = classes.join(wanted, "c", "left_semi").select("c", "k1", "k2", "n", "parity", F.coalesce("doc", F.lit(0)).alias("doc"))
        keys = written(keys, "ngram-keys")
        bits = self.spark.sparkContext.broadcast(_candidate_filter(keys.select("k1", "k2", "doc")))
        texts = self.docs.select(F.coalesce("doc", F.lit(0)).alias("doc"), "text")
        self.whole = written(texts.mapInArrow(_sets(self.n, bits), "k1 long, k2 long, set binary"), "ngram-sets")
        self.keys = keys
        labels, enough = None, shared.count() + members.count()
        for r in range(MOST_ROUNDS):
            labels = self._labels(labels, self._compare(self._star_pairs(shared, members, labels, r)))
            pairs = written(self._crossing_pairs(shared, members, labels), "ngram-crossings")
            if pairs.count() <= enough:  # else another star round, by other anchors, makes fewer
                break
        labels = self._labels(labels, self._compare(pairs, few=True))
        for table in (groups, shared, members, keys, self.whole):
            dropped(table)
        release(self.spark)

        c = classes.join(labels, F.col("c") == F.col("node"), "left").select("k1", "k2", "c", "doc", F.coalesce("root", "c").alias("root"))
        least = c.groupBy(F.col("root").alias("r")).agg(F.min("doc").alias("component_id"))
        c = c.join(least, F.col("root") == F.col("r")).select(F.col("k1").alias("x1"), F.col("k2").alias("x2"), "c", "root", "component_id")
        rows = profiles.select("doc", *self.tags, "k1", "k2", "n")
        j = rows.join(c, (F.col("k1") == F.col("x1")) & (F.col("k2") == F.col("x2")) & (F.col("n") > 0), "left")
        return j.select("doc", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"), "root", F.col("c").alias("class_id"), *[F.col(t).alias(name) for t, name in self.tags.items()])

    def _with_comp(self, rows: DataFrame, key: str, labels: DataFrame | None) -> DataFrame:
        if labels is None:
            return rows.withColumn("comp", F.col(key))
        lab = labels.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        return rows.join(lab, F.col(key) == F.col("_n"), "left").withColumn("comp", F.coalesce("_r", key)).drop("_n", "_r")

    def _star_pairs(self, shared: DataFrame, members: DataFrame, labels: DataFrame | None, r: int) -> DataFrame:
        size = F.floor(F.log("n") / F.log(F.lit(100 / self.percent)) + F.lit(1e-9)).cast("int")
        # the anchor: first the row with the fewest tokens rarer than this one, which an original has and its edited copies have not
        marks = [F.col("pos"), F.xxhash64("g")] if r == 0 else [F.xxhash64("g", "token", F.lit(r)), F.lit(0)]
        rows = self._with_comp(shared, "g", labels).select("token", "slice", "slices", "g", "n", "pos", "comp", size.alias("band"), *[m.alias(f"mark{i}") for i, m in enumerate(marks)])
        # a sliced run has one anchor for each band, which is sent to all of its slices
        first = rows.where("slices > 1").groupBy("token", "band").agg(F.min(F.struct("mark0", "mark1", "g", "n", "pos", "comp", "slices")).alias("x"))
        sent = first.select("token", F.explode(F.sequence(F.lit(0), F.col("x.slices") - 1)).alias("slice"), "x.slices", "x.g", "x.n", "x.pos", "x.comp", "band", "x.mark0", "x.mark1")
        laid = rows.unionByName(sent).repartition(self.parts, "token", "slice").sortWithinPartitions("token", "slice", "band", "mark0", "mark1")
        pairs = laid.mapInArrow(_stars(self.percent), "a long, b long")
        if r == 0:
            pairs = pairs.unionByName(members.where("c <> g").select(F.col("c").alias("a"), F.col("g").alias("b")))
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def _crossing_pairs(self, shared: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
        mine = self._with_comp(members, "c", labels)
        of_group = mine.groupBy(F.col("g").alias("mg")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        mixed = of_group.where("lo <> hi").select("mg")
        rows = self._with_comp(shared, "g", labels).join(mixed, F.col("g") == F.col("mg"), "left")
        rows = rows.select("token", "slices", "slice", "g", "n", "pos", F.when(F.col("mg").isNotNull(), F.lit(-1)).otherwise(F.col("comp")).alias("comp"))
        # a sliced run of one component needs no pairs, and isn't multiplied
        sliced = rows.where("slices > 1")
        span = sliced.groupBy(F.col("token").alias("t")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi or lo < 0")
        several = _blocks(sliced.join(span.select("t"), F.col("token") == F.col("t"), "left_semi"))
        whole = rows.where("slices = 1").select("*", F.lit(0).alias("i"), F.lit(0).alias("j"))
        laid = whole.unionByName(several).drop("slices").repartition(self.parts, "token", "i", "j").sortWithinPartitions("token", "i", "j")
        # a pair can share the tokens it was met at, and what room the last of them leaves
        met = laid.mapInArrow(_crossings(self.percent), "ga long, gb long, room long, need long").groupBy("ga", "gb")
        gpairs = met.agg(F.count("*").alias("met"), F.min("room").alias("room"), F.min("need").alias("need")).where("met + room >= need")
        gpairs = written(gpairs.select("ga", "gb"), "ngram-group-pairs")
        # expand to members: those of mixed groups; of a group that is of one component every member may matter too
        every = mine.select("g", "c", "comp")
        one = self._with_comp(gpairs.select(F.col("ga").alias("g")).unionByName(gpairs.select(F.col("gb").alias("g"))).distinct().withColumn("c", F.col("g")), "c", labels).select("g", "c", "comp")
        every = every.unionByName(one.join(every.select(F.col("g").alias("h")).distinct(), F.col("g") == F.col("h"), "left_anti"))
        a = every.select(F.col("g").alias("ga"), F.col("c").alias("a"), F.col("comp").alias("ca"))
        b = every.select(F.col("g").alias("gb"), F.col("c").alias("b"), F.col("comp").alias("cb"))
        across = gpairs.join(a, "ga").join(b, "gb").where("ca <> cb").select("a", "b")
        # within a group of several components: members are compared with those of other components
        slices = F.ceil(F.col("size") / self.slice_rows).cast("int")
        inner = mine.join(mixed, F.col("g") == F.col("mg"), "left_semi").withColumn("slices", slices).withColumn("slice", F.pmod(F.xxhash64("c"), F.col("slices")).cast("int"))
        blocks = _blocks(inner).select("g", "i", "j", "slice", "c", "comp", "n", "parity")
        within = blocks.repartition(self.parts, "g", "i", "j").sortWithinPartitions("g", "i", "j").mapInArrow(_inside(self.percent), "a long, b long")
        return across.unionByName(within).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def _compare(self, pairs: DataFrame, few: bool = False) -> DataFrame:
        """The pairs that link. few: most candidate sets are in none of them, and are left out before the joins.

        The pairs are written first, so that Spark knows their size (and broadcasts them if that is small).
        """
        whole = self.whole
        key = lambda c: self.keys.select(F.col("c").alias(c), F.col("k1").alias(f"{c}1"), F.col("k2").alias(f"{c}2"), F.col("n").alias(f"{c}n"), F.col("parity").alias(f"{c}p"))
        able = pairs.join(key("a"), "a").join(key("b"), "b").mapInArrow(_by_parity(self.percent), "a long, b long, a1 long, a2 long, b1 long, b2 long")
        pairs = written(able, "ngram-pairs")
        if few:
            ids = [pairs.select(F.col(f"{c}1").alias("k1"), F.col(f"{c}2").alias("k2")) for c in "ab"]
            whole = whole.join(ids[0].unionByName(ids[1]).distinct(), ["k1", "k2"], "left_semi")
        side = lambda c: whole.select(F.col("k1").alias(f"{c}1"), F.col("k2").alias(f"{c}2"), F.col("set").alias(f"set_{c}"))
        both = pairs.join(side("a"), ["a1", "a2"]).join(side("b"), ["b1", "b2"])
        return both.select("a", "b", "set_a", "set_b").mapInArrow(_verify(self.percent), "a long, b long")

    def _labels(self, labels: DataFrame | None, links: DataFrame) -> DataFrame:
        """Joins new links to the components so far."""
        edges = links
        if labels is not None:
            edges = edges.unionByName(labels.select(F.col("node").alias("a"), F.col("root").alias("b")))
        return components(edges)


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """id, n_shingles, component_id, class_id for every row."""
    return Join(docs, id_col, text_col, n, percent).result().withColumnRenamed("doc", id_col)
