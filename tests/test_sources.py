import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.sources import change_log, file_drop, row_versions

T0 = datetime(2026, 10, 1, 9)


def lsn(n):
    return bytearray(n.to_bytes(10, "big"))


def log(spark, rows):
    return spark.createDataFrame([(lsn(a), lsn(b), c, T0, i, v) for a, b, c, i, v in rows], "lsn BINARY, seq BINARY, code INT, commit_ts TIMESTAMP, id INT, v STRING")


def source(spark, rows, top=9, low=1):
    return change_log.ChangeLogSource("s", "db", [change_log.LogTable("dbo", "t", ["id"])], lambda t: log(spark, rows), lambda: top if top is None else bytes(lsn(top)), lambda t: bytes(lsn(low)))


def test_log_rows_become_changes(spark):
    got = source(spark, [(1, 1, 2, 1, "a"), (2, 1, 3, 1, "a"), (2, 1, 4, 1, "b"), (3, 1, 1, 1, "b")]).capture(None, "tr")
    ev = {r["source"]["position"]: r for r in got.events.collect()}
    assert [ev[k]["op"] for k in sorted(ev)] == ["c", "u", "d"]
    c, u, d = (ev[k] for k in sorted(ev))
    assert c["before"] is None and '"v":"a"' in u["before"] and '"v":"b"' in u["after"] and d["after"] is None and '"v":"b"' in d["before"]
    assert c["source"]["position"] == "0x00000000000000000001:0x00000000000000000001" and c["key"] == '{"id":1}'
    assert got.watermark == {"lsn": {"dbo.t": "0x" + bytes(lsn(9)).hex()}}


def test_log_goes_on_after_the_watermark(spark):
    s = source(spark, [(1, 1, 2, 1, "a"), (5, 1, 2, 2, "b")])
    mark = {"lsn": {"dbo.t": "0x" + bytes(lsn(1)).hex()}}
    assert [r["key"] for r in s.capture(mark, "t").events.collect()] == ['{"id":2}']


def test_log_gap_is_an_error_but_equality_is_not(spark):
    mark = {"lsn": {"dbo.t": "0x" + bytes(lsn(2)).hex()}}
    with pytest.raises(change_log.GapError, match="new snapshot"):
        source(spark, [], low=3).capture(mark, "t")
    source(spark, [], low=2).capture(mark, "t")


def test_log_without_an_end_changes_nothing(spark):
    got = source(spark, [], top=None).capture({"lsn": {"x": "0x01"}}, "t")
    assert got.events is None and got.watermark == {"lsn": {"x": "0x01"}}


def test_unknown_operation_code_stops(spark):
    with pytest.raises(Exception, match="unexpected operation code 9"):
        source(spark, [(1, 1, 9, 1, "a")]).capture(None, "t").events.collect()


class Loans:
    """A table polled by its change time, with the state that runs leave behind."""

    def __init__(self, spark, every=3):
        self.spark, self.rows, self.now, self.kept, self.mark = spark, {}, T0, None, None
        self.src = row_versions.RowVersionSource("db2", "core", [row_versions.VersionedRows("CORE", "LOANS", ["ID"], "CH")], lambda t: spark.createDataFrame([(k, v, c) for k, (v, c) in self.rows.items()], "ID INT, V STRING, CH TIMESTAMP"), lambda: self.now, lambda t: self.kept, every)

    def run(self):
        got = self.src.capture(self.mark, "t")
        ev = sorted((r["op"], r["key"], r["event_id"]) for r in got.events.collect())
        state = got.state["CORE.LOANS"]
        self.kept, self.mark = self.spark.createDataFrame(state.collect(), state.schema), got.watermark
        return ev


def test_rows_are_polled_compared_and_deleted(spark):
    t = Loans(spark)
    t.rows = {1: ("a", T0 - timedelta(minutes=5)), 2: ("b", T0 - timedelta(minutes=4))}
    assert {e[0] for e in t.run()} == {"c"}
    assert t.run() == []  # nothing new: rows at the watermark were given already
    t.rows[1] = ("A", T0 + timedelta(minutes=1))
    t.rows[3] = ("c", T0 - timedelta(minutes=4))  # late, with the watermark's own time
    del t.rows[2]
    t.now = T0 + timedelta(minutes=2)
    assert [(e[0], e[1]) for e in t.run()] == [("c", '{"ID":3}'), ("u", '{"ID":1}')]
    t.now += timedelta(minutes=1)
    ops = t.run() + t.run()
    assert all(e[0] == "d" for e in ops)


def test_snapshot_cadence():
    state, seen = {}, []
    for _ in range(7):
        due, runs = row_versions.snapshot_due(state, 3)
        state = {"runs_since_snapshot": runs}
        seen.append(due)
    assert seen == [True, False, False, True, False, False, True]


def test_a_row_changed_within_the_lag_is_not_taken_for_deleted(spark):
    t = Loans(spark, every=1)
    t.rows = {1: ("a", T0 - timedelta(minutes=5))}
    t.run()
    t.rows = {1: ("b", T0 - timedelta(seconds=1))}  # inside the safety lag
    assert t.run() == []
    t.now = T0 + timedelta(minutes=1)
    assert {e[0] for e in t.run()} == {"u"}


def test_delete_insert_delete_gives_two_deletes(spark):
    t = Loans(spark, every=1)
    ids = []
    for k in range(2):
        t.rows = {1: ("same", T0 + timedelta(minutes=10 * k))}
        t.now = T0 + timedelta(minutes=10 * k + 1)
        t.run()
        t.rows = {2: ("other", T0)}
        t.now += timedelta(minutes=1)
        ids += [e[2] for e in t.run() if e[0] == "d"]
    assert len(set(ids)) == 2


def test_snapshot_changes(spark):
    now = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id INT, fingerprint STRING")
    known = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id INT, fingerprint STRING")
    got = sorted((r["id"], r["op"]) for r in row_versions.snapshot_changes(now, known, ["id"]).collect())
    assert got == [(2, "u"), (3, "d"), (4, "c")]


GOOD = "T{},2026-10-01,2026-10-01T09:00:00,GB82WEST12345698765432,DE89370400440532013000,{},EUR,ref"
HEAD = ",".join(file_drop.TRANSFER_COLUMNS)


def test_files_are_captured_once_and_again_when_changed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEAD, GOOD.format(1, "10.00"), GOOD.format(2, "abc"), GOOD.format(3, "5.00").replace("GB82", "GB83"), GOOD.format(4, "1.00") + ",extra", ""]))
    (tmp_path / "notes.txt").write_text("ignored")
    taken = []
    s = file_drop.FileDropSource(spark, str(tmp_path), manifest=lambda: spark.createDataFrame(taken, "file_name STRING, etag STRING") if taken else None)
    got = s.capture(None, "t")
    ev = got.events.collect()
    assert [(r["op"], r["key"]) for r in ev] == [("c", '{"transfer_id":"T1"}')]
    assert ev[0]["source"]["position"].startswith("a.csv:2@") and ev[0]["source"]["sequence"].endswith("|a.csv|000000002")
    assert sorted(r["reason"] for r in got.rejects.collect()) == ["invalid amount", "invalid debtor_iban", "malformed record"]
    m = got.manifest.first()
    assert (m["rows"], m["rejected"], m["file_name"]) == (1, 3, "a.csv")
    assert s.stats() == {"partner_transfers": {"rows": 1}}
    taken.append((m["file_name"], m["etag"]))
    assert s.capture(got.watermark, "t").events is None and got.watermark == {"files": 1}
    import os

    (tmp_path / "a.csv").write_text("\n".join([HEAD, GOOD.format(1, "11.00"), ""]))
    os.utime(tmp_path / "a.csv", (2e9, 2e9))
    again = s.capture(got.watermark, "t").events.collect()
    assert [(r["op"], '"11.00"' in r["after"]) for r in again] == [("u", True)]


def test_a_file_that_is_not_utf8_is_refused_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xff\xfe" + HEAD.encode())
    got = file_drop.FileDropSource(spark, str(tmp_path)).capture(None, "t")
    assert got.events.count() == 0 and [r["reason"] for r in got.rejects.collect()] == ["not valid UTF-8"]


class Share:
    """A client of a share with a folder, a file of another kind and two CSV files."""

    files = {"a.csv": f"{HEAD}\n{GOOD.format(1, '10.00')}\n", "b.csv": f"{HEAD}\n{GOOD.format(2, '20.00')}\n", "c.txt": "no"}

    def list_directories_and_files(self):
        return [{"name": "sub.csv", "is_directory": True}, *({"name": n, "is_directory": False} for n in self.files)]

    def get_file_client(self, name):
        self.name = name
        return self

    def get_file_properties(self):
        from types import SimpleNamespace

        return SimpleNamespace(etag=f'"0x{self.name}"', size=len(self.files[self.name]), last_modified=T0)

    def download_file(self):
        return self

    def readall(self):
        return self.files[self.name].encode()


def test_a_share_with_a_client_of_its_own(spark):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors don't have the tests
    taken = []
    s = file_drop.FileDropSource(spark, file_drop.RemoteShare(spark, Share), manifest=lambda: spark.createDataFrame(taken, "file_name STRING, etag STRING") if taken else None)
    got = s.capture(None, "t")
    assert sorted(r["key"] for r in got.events.collect()) == ['{"transfer_id":"T1"}', '{"transfer_id":"T2"}']
    taken += [(r["file_name"], r["etag"]) for r in got.manifest.collect()]
    assert [e for _, e in sorted(taken)] == ["0xa.csv", "0xb.csv"] and s.capture(got.watermark, "t").events is None
    assert s.stats() == {"partner_transfers": {"rows": 2}}


def test_a_file_is_never_one_row(spark, tmp_path):
    import hashlib

    from tidemark.sources import text_pieces

    lines = [GOOD.format(i, "abc" if i % 5 == 0 else "10.00").replace(",ref", ',"a ""b"",\r\n\nc"') for i in range(60)]
    data = b"\xef\xbb\xbf" + "\r\n".join([HEAD, "", *lines, 'T60,"open\r']).encode()
    (tmp_path / "a b+.csv").write_bytes(data)
    limits = {"spark.sql.sources.binaryFile.maxLength": "100", "spark.sql.files.maxPartitionBytes": "997", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        s = file_drop.FileDropSource(spark, str(tmp_path))
        got = s.capture(None, "t")
        sha = hashlib.sha256(data).hexdigest()
        want = {f"a b+.csv:{i + 2}@{sha[:12]}": f"T{i}" for i in range(60)}
        events = {r["source"]["position"]: (r["key"], '"a \\"b\\",\\n\\nc"' in r["after"]) for r in got.events.collect()}
        assert events == {p: (f'{{"transfer_id":"{t}"}}', True) for p, t in want.items() if int(t[1:]) % 5}
        rejects = {r["position"]: (r["reason"], r["raw"]) for r in got.rejects.collect()}
        assert rejects.pop(f"a b+.csv:62@{sha[:12]}") == ("malformed record", 'T60,"open\n')
        assert rejects.keys() == want.keys() - events.keys() and {r for r, _ in rejects.values()} == {"invalid amount"}
        m = got.manifest.first()
        assert (m["sha256"], m["size"], m["rows"], m["rejected"]) == (sha, len(data), 48, 13)
        assert s.stats() == {"partner_transfers": {"rows": 48}}
        cut = text_pieces.pieces(s.files.lines(["a b+.csv"]), 500).collect()
        assert len(cut) > 10 and all(len(r["text"].encode()) <= 500 for r in cut)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_share_read_in_chunks(spark):
    import sys

    from pyspark import cloudpickle

    class Chunks(Share):
        files = {"a.csv": f"\ufeff{HEAD}\n{GOOD.format(1, '10.00')}\n{GOOD.format(2, '20.00')}"}

        def get_file_properties(self):
            p = super().get_file_properties()
            p.size = len(self.files[self.name].encode())
            return p

        def chunks(self):
            data = self.files[self.name].encode()
            yield from (data[i : i + 5] for i in range(0, len(data), 5))

        def readall(self):
            raise AssertionError("read whole")

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    got = file_drop.FileDropSource(spark, file_drop.RemoteShare(spark, Chunks)).capture(None, "t")
    assert sorted(r["key"] for r in got.events.collect()) == ['{"transfer_id":"T1"}', '{"transfer_id":"T2"}']


def test_long_fields_and_unbalanced_quotes(spark):
    big = "x" * (1 << 20)
    quoted = '"' + "y,\n" * (1 << 18) + '""z"'
    text = f"a,b\n1,{big}\n2,{quoted}\n3,w\n4,\"open {big}"
    df = spark.createDataFrame([("f", text)], "name STRING, content STRING")
    got = {r["line"]: r["row"] for r in file_drop.csv_rows(df, "content", ["a", "b"]).collect()}
    assert tuple(got[2]) == ("1", big) and tuple(got[3]) == ("2", "y,\n" * (1 << 18) + '"z') and tuple(got[4]) == ("3", "w") and got[5] is None


def test_csv_quoting(spark):
    text = 'a,b\n1,"x, ""y""\nz"\n2,\n3\n"4",w\r\n'
    df = spark.createDataFrame([("f", text)], "name STRING, content STRING")
    got = [(r["line"], tuple(r["row"]) if r["row"] else None) for r in file_drop.csv_rows(df, "content", ["a", "b"]).orderBy("line").collect()]
    assert got == [(2, ("1", 'x, "y"\nz')), (3, ("2", "")), (4, ("3", None)), (5, ("4", "w"))]


def test_after_watermark_is_inclusive_without_given_keys(spark):
    df = spark.createDataFrame([(i, T0 + timedelta(seconds=s)) for i, s in enumerate((0, 5, 5, 9, 20))], "id INT, ts TIMESTAMP")
    at = F.lit("2026-10-01 09:00:05").cast("timestamp")
    end = F.lit("2026-10-01 09:00:20").cast("timestamp")
    got = row_versions.after_watermark(df, "ts", at, end, ["id"], spark.createDataFrame([(1,)], "id INT"))
    assert sorted(r["id"] for r in got.collect()) == [2, 3]


def test_quotes_inside_plain_fields_are_text(spark, tmp_path):
    """A quote opens a quoted field only at the field's start."""
    refs = {2: '5" pipe', 4: '"doubled ""q"" here"', 5: '6" pipe', 6: '"closed" and more "'}
    (tmp_path / "a.csv").write_text("\n".join([HEAD, *[GOOD.format(i, "10.00").replace(",ref", "," + refs.get(i, "ref")) for i in range(1, 7)], ""]))
    got = file_drop.FileDropSource(spark, str(tmp_path)).capture(None, "t")
    events = {r["source"]["position"].split("@")[0]: (r["key"], json.loads(r["after"])["reference"]) for r in got.events.collect()}
    said = {2: '5" pipe', 4: 'doubled "q" here', 5: '6" pipe', 6: 'closed and more "'}
    assert events == {f"a.csv:{i + 1}": (f'{{"transfer_id":"T{i}"}}', said.get(i, "ref")) for i in range(1, 7)} and got.rejects.count() == 0


def test_the_automaton_by_runs_equals_the_one_by_bytes():
    from tidemark.sources import text_pieces

    def plain(text, state):
        out = []
        for i, c in enumerate(text):
            if state == "quoted":
                state = "behind" if c == '"' else state
            elif c in ",\n":
                state = "start"
            elif c == '"' and state != "plain":
                state = "quoted"
            else:
                state = "plain"
            if c == "\n" and state == "start":
                out.append(i)
        return out, state == "quoted"

    ends, r = text_pieces._automaton(), random.Random(1)
    for _ in range(5000):
        text = "".join(r.choices('",\na"', k=r.randint(0, 14))) + "\n"
        for inside in (False, True):
            found, end = ends(text.encode(), inside)
            assert (found.tolist(), end) == plain(text, "quoted" if inside else "start"), text


@pytest.mark.parametrize("seed, chunk, piece, unclosed, end", [(1, 1, 40, False, "\n"), (2, 60, 1, False, ""), (3, 100, 100, True, "\r\n"), (4, 1 << 20, 1 << 18, True, ""), (5, 7, 30, True, "\n")])
def test_records_cut_in_parallel_are_those_of_a_csv_reader(spark, tmp_path, seed, chunk, piece, unclosed, end):
    import csv
    import io

    from tidemark.sources import text_pieces

    r = random.Random(seed)
    field = lambda: "".join(r.choices(['"', '""', "a", "é", " ", "b c"], k=r.randint(0, 4)))
    quoted = lambda: '"' + "".join(r.choices(['""', ",", "\n", "\r\n", "x", "日"], k=r.randint(0, 6))) + '"' + r.choice(["", "", 'tail"'])
    plain = lambda: r.choice("xyz") + field()
    record = lambda: ",".join(r.choice([plain, quoted, str])() for _ in range(r.randint(1, 4)))
    breaks = ["\n", "\r\n", "\n\n", "\r\n\n"]
    text = "\n" + 'a,"b\n1","c"' + "".join(r.choice(breaks) + record() for _ in range(300)) + ("\n1,\"open, ""\n,x" if unclosed else "") + end
    (tmp_path / "x y.csv").write_bytes(text.encode())
    (tmp_path / "other.csv").write_bytes(b'a,"b\n1","c"\n1,2,3\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        lines = file_drop.Folder(spark, str(tmp_path)).lines(["x y.csv", "other.csv"])
        cut = text_pieces.pieces(lines, piece, chunk)
        rows = file_drop.csv_rows(cut, "text", ["a", "b\n1", "c"], "header", "first").select("name", "line", "row", "unclosed").collect()
        if chunk < 1000:
            assert cut.where("name = 'x y.csv'").count() > 20 and lines.select("block").distinct().count() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    header, *want = [x for x in csv.reader(io.StringIO(text, newline=None)) if x]
    assert header == ["a", "b\n1", "c"]
    got = {x["line"]: x["row"] for x in rows if x["name"] == "x y.csv"}
    assert sorted(got) == list(range(2, len(want) + 2))
    for i, fields in enumerate(want):
        row = got[i + 2]
        if len(fields) > 3 or (unclosed and i == len(want) - 1):
            assert row is None
        else:
            assert list(row) == fields + [None] * (3 - len(fields)), (i, fields)
    assert [(x["line"], list(x["row"])) for x in rows if x["name"] == "other.csv"] == [(2, ["1", "2", "3"])]


def test_a_header_beyond_the_first_split_refuses_the_records(spark, tmp_path):
    from tidemark.sources import text_pieces

    (tmp_path / "a.csv").write_text('a,"never closed\n' + "1,2\n" * 50)
    (tmp_path / "b.csv").write_text('a,"b' + "\n" * 500 + '"\n1,2\n3,4\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        cut = text_pieces.pieces(file_drop.Folder(spark, str(tmp_path)).lines(["a.csv", "b.csv"]))
        got = sorted((r["name"], r["line"], r["row"]) for r in file_drop.csv_rows(cut, "text", ["a"], "header", "first").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [("b.csv", 2, None), ("b.csv", 3, None)]


@pytest.mark.parametrize("changed", [0, 3, 400])
def test_only_ranges_that_differ_are_joined(spark, monkeypatch, changed):
    from tidemark.sources import range_digests

    monkeypatch.setattr(range_digests, "BITS", 4)
    monkeypatch.setattr(range_digests, "LEAF", 40)
    n = 5000
    known = spark.range(n).select((F.col("id") % 50).alias("a"), (F.col("id") / 50).cast("int").cast("string").alias("b"), F.lit("f").alias("fingerprint"), F.lit("t").alias("ts"))
    known = known.union(spark.createDataFrame([(7, None, "f", "t")], "a LONG, b STRING, fingerprint STRING, ts STRING"))
    pick = F.xxhash64("a", "b") % max(1, n // max(changed, 1)) == 0
    now = known.drop("ts").select(F.col("a").cast("int").alias("a"), "b", F.when(pick & F.lit(changed > 0), "g").otherwise(F.col("fingerprint")).alias("fingerprint"))
    now = now.union(spark.createDataFrame([(99, "new", "f")] if changed else [], "a INT, b STRING, fingerprint STRING")).where(~((F.col("a") == 3) & (F.col("b") == "3")) | F.lit(changed == 0))
    differ = range_digests.Ranges(now, known, ["a", "b"])
    some = differ.of(now).count() + differ.of(known).count()
    full = sorted(map(tuple, row_versions.snapshot_changes(now, known.drop("ts"), ["a", "b"]).select("a", "b", "op").where("b is not null").collect()))
    got = sorted(map(tuple, row_versions.snapshot_changes(differ.of(now), differ.of(known.drop("ts")), ["a", "b"]).select("a", "b", "op").where("b is not null").collect()))
    assert got == full and (len(full) > 2) == (changed > 0)
    assert some <= 80 * len(full) and (changed == 400 or some < n)
    assert differ.of(known).columns == known.columns


def test_a_log_as_a_stream(spark, tmp_path):
    """Offsets are positions: an empty log, a restart in the middle, a repeat of nothing, and a gap, which stops the query."""
    from tidemark.sources import log_stream

    ddl = "lsn BINARY, seq BINARY, code INT, id INT"
    uri, ck, got = f"file://{tmp_path}/log", f"{tmp_path}/ck", []

    def run(oldest=None):
        spark.dataSource.register(log_stream.log_source(log_stream.parquet_log(uri, ["lsn", "seq", "code", "id"], oldest), ddl, "small_log", 3))
        seen = []
        stream = spark.readStream.format("small_log").load()
        stream.writeStream.foreachBatch(lambda b, n: seen.extend((int.from_bytes(r["lsn"], "big"), r["code"], r["id"]) for r in b.collect())).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
        got.append(sorted(seen))

    def write(*positions):
        spark.createDataFrame([(lsn(p), lsn(1), c, p) for p in positions for c in ((3, 4) if p % 2 else (2,))], ddl).repartition(2).write.mode("append").parquet(f"{tmp_path}/log")

    run()
    write(*range(5, 12))
    run()
    run()
    write(*range(12, 20))
    run(lsn(11))
    rows = lambda lo, hi: sorted((p, c, p) for p in range(lo, hi) for c in ((3, 4) if p % 2 else (2,)))
    assert got == [[], rows(5, 12), [], rows(12, 20)]
    write(40, 41)
    with pytest.raises(Exception, match="older than the oldest one kept"):
        run(lsn(30))


def test_statistics_read_no_file_twice(spark, tmp_path, monkeypatch):
    import os

    from tidemark import pipeline
    from tidemark.tables import Tables

    drop, tables, taken, read = tmp_path / "drop", Tables(spark, f"{tmp_path}/t"), [], []
    drop.mkdir()
    source = file_drop.FileDropSource(spark, str(drop), manifest=lambda: spark.createDataFrame(taken, "file_name STRING, etag STRING") if taken else None, ids=lambda: pipeline.file_ids(tables, "d"))
    full = file_drop.FileDropSource(spark, str(drop))
    whole = file_drop.FileDropSource._read
    monkeypatch.setattr(file_drop.FileDropSource, "_read", lambda self, found: (read.append(sorted(f["name"] for f in found)), whole(self, found))[1])

    def put(name, ids, at):
        (drop / name).write_text("\n".join([HEAD, *[GOOD.format(i, "abc" if i % 5 == 0 else "1.00") for i in ids], ""]))
        os.utime(drop / name, (at, at))

    def capture():
        got = source.capture(None, "t")
        pipeline.keep_ids(tables, "d", got.ids)
        taken.extend((r["file_name"], r["etag"]) for r in got.manifest.collect())

    def same():
        read.clear()
        ours = source.stats()
        mine = list(read)
        assert ours == full.stats()
        return ours["partner_transfers"]["rows"], mine

    assert same() == (0, [])
    put("a.csv", range(1, 10), 1e9)
    put("b.csv", range(7, 14), 1e9)
    capture()
    assert same() == (11, [])
    put("a.csv", range(1, 4), 2e9)  # comes again, not taken yet
    assert same() == (9, [["a.csv"]])
    capture()
    assert same() == (9, [])
    put("a.csv", [5, 10], 3e9)  # and once more, without a valid row
    capture()
    assert same() == (6, [])
    os.remove(drop / "b.csv")
    assert same() == (0, [])


def test_a_file_that_is_split_in_another_way_is_not_cut():
    from tidemark.sources import text_pieces

    cut = text_pieces._cut(100)
    import pyarrow as pa

    row = {"name": ["a.csv"], "block": pa.array([7], pa.int64()), "seq": pa.array([0], pa.int32()), "data": [b"1,2\n"], "inside": pa.array([None], pa.bool_()), "before": pa.array([None], pa.int64()), "header": pa.array([None], pa.string())}
    with pytest.raises(RuntimeError, match="split in another way"):
        list(cut([pa.RecordBatch.from_pydict(row)]))
