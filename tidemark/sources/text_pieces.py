"""Files of any size as lines: a hash of each file, and its text in pieces that end where a CSV record ends.

Lines have the columns name, block and at, which order a file's lines, and line: bytes of one or more whole lines, each with its
"\\n" (the last one too, whether the file has it or not). A byte order mark at the start of a file is left out. A hash needs its bytes in
order, so for that the lines of a file are dealt to one task, sorted (Spark spills) and passed through.

Records are cut in parallel. Whether a byte is at the start of a field, in a plain field, in a quoted one or behind a quote in a quoted one
depends on all bytes before it; but a chunk of lines is a map of these four states, which its bytes alone give, and at a line end only
two of them are left: start of a field, and quoted. So (1) every split of a file says, for either state that it may begin in, in which it
ends and how many records end in it; (2) the maps of a file, a small row a chunk, are composed in order, which gives each chunk its state and
the number of its first record; (3) all chunks are cut at once, and records that cross a border are put together. The functions are sent
by value, executors need not have this package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINES = "name STRING, block LONG, at LONG, line BINARY"
DIGESTS = "name STRING, bytes LONG, plain STRING, plain_open STRING, marked STRING, marked_open STRING, valid BOOLEAN"
PIECES = "name STRING, header STRING, first LONG, text STRING, unclosed BOOLEAN"

MARK = b"\xef\xbb\xbf"
#: Bytes of a piece, unless a record is longer, and of a chunk, unless a line is.
PIECE, CHUNK = 1 << 18, 1 << 20

MAPS = "name STRING, block LONG, seq INT, n0 LONG, n1 LONG, in0 BOOLEAN, in1 BOOLEAN, head STRING"
STARTS = "name STRING, block LONG, seq INT, inside BOOLEAN, before LONG, header STRING"
CHUNKS = "name STRING, block LONG, seq INT, data BINARY"
PARTS = "name STRING, first LONG, block LONG, seq INT, text STRING, part STRING, crlf BOOLEAN, header STRING"


def in_order(lines: DataFrame) -> DataFrame:
    return lines.repartition("name").sortWithinPartitions("name", "block", "at")


def _runs():
    """A function from batches of lines to (name, bytes) of each run of lines of one file."""

    def runs(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            if not b.num_rows:
                continue
            names, lines = b.column("name"), b.column("line").cast(pa.large_binary())
            offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
            data, start = memoryview(lines.buffers()[2]), 0
            for end in pc.run_end_encode(names).run_ends.to_pylist():
                yield names[start].as_py(), bytes(data[offsets[start] : offsets[end]])
                start = end

    return runs


def digests(lines: DataFrame) -> DataFrame:
    """Of each file: bytes of its lines, whether it is valid UTF-8, and its SHA-256 if it has neither a byte order mark nor lacks
    the last line end (plain), lacks that (plain_open), has the mark (marked), or both (marked_open). See `sha256`."""
    runs, mark, schema = _runs(), MARK, ["name", "bytes", "plain", "plain_open", "marked", "marked_open", "valid"]

    def digest(batches):
        import hashlib
        from itertools import groupby

        import pyarrow as pa

        for name, parts in groupby(runs(batches), key=lambda x: x[0]):
            plain, marked, size, valid = hashlib.sha256(), hashlib.sha256(mark), 0, True
            for _, data in parts:
                for h in (plain, marked):
                    if size:
                        h.update(b"\n")  # held back, as the last one may not be there
                    h.update(memoryview(data)[:-1])
                size += len(data)
                if valid:
                    try:
                        data.decode()
                    except UnicodeDecodeError:
                        valid = False
            out = [name, size]
            for h in (plain, marked):
                whole = h.copy()
                whole.update(b"\n")
                out += [whole.hexdigest(), h.hexdigest()]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in [*out, valid]], names=schema)

    return in_order(lines).mapInArrow(digest, DIGESTS)


def sha256(row, size: int) -> tuple[str, bool] | None:
    """SHA-256 of a file of `size` bytes and whether it lacks the last line end, by its row of `digests` (None: it has no lines).
    None if the lines aren't those of a file of this size."""
    import hashlib

    if row is None:
        return {0: (hashlib.sha256().hexdigest(), True), len(MARK): (hashlib.sha256(MARK).hexdigest(), True)}.get(size)
    found = {0: ("plain", False), -1: ("plain_open", True), len(MARK): ("marked", False), len(MARK) - 1: ("marked_open", True)}.get(size - row["bytes"])
    return found and (row[found[0]], found[1])


def _automaton():
    """A function from text, whose line ends are "\\n" and which begins and ends at a line end, and whether it begins within quotes, to the places of
    the line ends that end a record, and whether it ends within quotes.

    A quote opens a field only at the field's start. So a run of quotes of odd length turns the state if a comma or line end stands before it
    (outside quotes it opens a field, within it closes one), and else leaves quotes whatever the state was; one of even length changes nothing. The
    state behind a run is the parity of the turning runs since the last that left quotes.
    """

    def record_ends(text, inside):
        import numpy as np

        b = np.frombuffer(text, np.uint8)
        edge = np.flatnonzero(np.diff((b == 34).view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        start, stop = edge[::2], edge[1::2]
        odd = (stop - start) % 2 == 1
        start, stop = start[odd], stop[odd]
        before = np.where(start > 0, b[start - 1], 10)
        turns = (before == 44) | (before == 10)
        count = np.cumsum(turns)
        left = np.maximum.accumulate(np.where(turns, -1, np.arange(len(turns))))
        state = np.where(left >= 0, count - count[np.maximum(left, 0)], count + inside) % 2
        breaks = np.flatnonzero(b == 10)
        last = np.searchsorted(stop, breaks, side="right") - 1
        at = np.where(last >= 0, state[np.maximum(last, 0)], inside) if len(state) else np.full(len(breaks), inside)
        return breaks[at == 0], bool(state[-1] if len(state) else inside)

    return record_ends


def _chunks(limit: int):
    """A function from batches of lines, those of a split together and in order, to (name, block, seq, bytes) of chunks of whole lines. A chunk
    ends with the line in which it reaches `limit`, however batches fall; the first one of a file, with its first record at least."""
    ends = _automaton()

    def split(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            names, blocks, lines = b.column("name"), b.column("block").to_numpy(), b.column("line").cast(pa.large_binary())
            offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
            data, codes = memoryview(lines.buffers()[2]), names.dictionary_encode().indices.to_numpy()
            cut = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(codes)]):
                yield (names[lo].as_py(), int(blocks[lo])), bytes(data[offsets[lo] : offsets[hi]])

    def has_record(data):
        import numpy as np

        found, _ = ends(data.replace(b"\r\n", b"\n").replace(b"\r", b"\n"), False)
        return bool((np.diff(found, prepend=-1) > 1).any())

    def chunks(batches):
        from itertools import groupby

        for (name, block), parts in groupby(split(batches), key=lambda x: x[0]):
            seq, held, start, tried = 0, bytearray(), 0, limit
            for _, data in parts:
                held += data
                while (cut := held.find(b"\n", start + tried - 1) + 1) > 0:
                    if block == 0 and seq == 0 and not has_record(bytes(held[:cut])):
                        tried = 2 * cut  # of the same bytes, whatever the batches
                        continue
                    yield name, block, seq, bytes(held[start:cut])
                    seq, start, tried = seq + 1, cut, limit
                del held[:start]
                start = 0
            if held:
                yield name, block, seq, bytes(held)

    return chunks


def _maps(limit: int):
    chunks, ends = _chunks(limit), _automaton()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for name, block, seq, data in chunks(batches):
            text = data.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
            out, head = [], None
            for inside in (False, True):
                found, end = ends(text, inside)
                some = np.diff(found, prepend=-1) > 1
                if inside:
                    some[:1] = True
                elif block == 0 and seq == 0 and some.any():
                    i = int(np.argmax(some))
                    head = text[int(found[i - 1]) + 1 if i else 0 : found[i]].decode()
                out.append((int(some.sum()), end))
            row = (name, block, seq, out[0][0], out[1][0], out[0][1], out[1][1], head)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()), strict=True)], names=["name", "block", "seq", "n0", "n1", "in0", "in1", "head"])

    return run


def _starts():
    """The maps of a file, in order, composed: the state and the number of records before each chunk."""

    def run(batches):
        import pyarrow as pa

        last, inside, before, header = None, False, 0, None
        for b in batches:
            states, counts, headers = [], [], []
            for name, n0, n1, in0, in1, head in zip(*[b.column(c).to_pylist() for c in ("name", "n0", "n1", "in0", "in1", "head")]):
                if name != last:
                    last, inside, before, header = name, False, 0, None
                header = header or head
                states.append(inside)
                counts.append(before)
                headers.append(header)
                inside, before = (in1, before + n1) if inside else (in0, before + n0)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("name", "block", "seq")], pa.array(states, pa.bool_()), pa.array(counts, pa.int64()), pa.array(headers, pa.string())], names=["name", "block", "seq", "inside", "before", "header"])

    return run


def _cut(piece: int):
    ends = _automaton()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.string())

        def cut(name, block, seq, data, inside, before, header):
            if inside is None:  # the two reads must see the same splits, which Spark makes for the cores that it has
                raise RuntimeError(f"{name} was split in another way when it was read again: run the capture anew")

            def out(first, text, part):
                row = (name, first, block, seq, text.decode(), part, data.endswith(b"\r\n"), header)
                return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=["name", "first", "block", "seq", "text", "part", "crlf", "header"])

            text = data.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
            found, _ = ends(text, inside)
            empty = np.diff(found, prepend=-1) == 1
            number, i = before + 1, 0
            if inside:
                if not len(found):
                    yield out(number, text, "middle")
                    return
                yield out(number, text[: found[0] + 1], "close")
                number, i = number + 1, 1
            if number == 1:  # the header, and empty lines before it
                full = np.flatnonzero(~empty[i:])
                i, number = (i + int(full[0]) + 1, 2) if len(full) else (len(found), 1)
            start = int(found[i - 1]) + 1 if i else 0
            while i < len(found):
                k = max(i + 1, int(np.searchsorted(found, start + piece)))
                n = int((~empty[i:k]).sum())
                if n:
                    yield out(number, text[start : found[k - 1] + 1], "whole")
                number, i, start = number + n, k, int(found[k - 1]) + 1
            if start < len(text):
                yield out(number, text[start:], "open")

        for b in batches:
            for row in zip(*[b.column(c).to_pylist() for c in ("name", "block", "seq", "data", "inside", "before", "header")]):
                yield from cut(*row)

    return run


def _joined():
    """Parts of records put together; they lie one after the other."""

    def run(batches):
        import pyarrow as pa

        def out(name, header, first, text, unclosed):
            row, kinds = (name, header, first, text, unclosed), (pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=["name", "header", "first", "text", "unclosed"])

        rest, of, crlf = [], None, False

        def ended():
            if rest and of[1] > 1:
                yield out(of[0], of[2], of[1], "".join(rest), not crlf)
            rest.clear()

        for b in batches:
            for name, first, text, part, end, header in zip(*[b.column(c).to_pylist() for c in ("name", "first", "text", "part", "crlf", "header")]):
                if rest and (name, first) != of[:2]:
                    yield from ended()
                if part == "whole":
                    yield out(name, header, first, text, False)
                    continue
                rest.append(text)
                of, crlf = (name, first, header), end
                if part == "close":
                    if first > 1:
                        yield out(name, header, first, "".join(rest), False)
                    rest.clear()
        yield from ended()

    return run


def pieces(lines: DataFrame, piece: int = PIECE, chunk: int = CHUNK) -> DataFrame:
    """header (the first record), first (the number of the first record; the header's is 1) and text of pieces that are whole records
    after the header; line ends are "\\n". Empty lines outside quotes aren't records. unclosed: the piece is a record whose quote isn't
    closed before the file ends; its last "\\n" isn't there if the file lacks the last line end. header is null if the first record goes on beyond the
    first split of its file. Files must be valid UTF-8. Lines are read twice, in the same
    splits (else the query fails, as when cores come between the reads); what a task holds is a chunk, or a record that is longer.
    """
    order = ["name", "block", "seq"]
    chunks, names = _chunks(chunk), ["name", "block", "seq", "data"]

    def whole(batches):
        import pyarrow as pa

        for row in chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.string(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=names)

    starts = lines.mapInArrow(_maps(chunk), MAPS).repartition("name").sortWithinPartitions(*order).mapInArrow(_starts(), STARTS)
    parts = lines.mapInArrow(whole, CHUNKS).join(starts, order, "left").mapInArrow(_cut(piece), PARTS)
    return parts.repartition("name", "first").sortWithinPartitions("name", "first", "block", "seq").mapInArrow(_joined(), PIECES)


def file_name(url):
    """The name of a file by its encoded one, in which a plus is a plus."""
    return F.url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))
