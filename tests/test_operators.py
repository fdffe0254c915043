import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import fold, quality, rules
from tidemark.streaming.silver import Entity, entity_state

T0 = datetime(2026, 10, 1, 9)
ACCOUNTS = Entity("dbo.accounts", "silver_accounts", ["account_id"], "account_id INT, balance DECIMAL(18,2), status STRING")
COLUMNS = "event_id STRING, op STRING, source_table STRING, source_sequence STRING, source_commit_ts TIMESTAMP, before_json STRING, after_json STRING, key_json STRING"


def change(event, op, seq, balance="100.00", status="ACTIVE", key=1, image=True, at=T0):
    import json

    row = json.dumps({"account_id": key, "balance": balance, "status": status}) if image else None
    return (event, op, "dbo.accounts", seq, at, row if op == "d" else None, None if op == "d" else row, json.dumps({"account_id": key}))


def state(spark, *batches):
    s = None
    for b in batches:
        s = fold.merge(s, entity_state(spark.createDataFrame(list(b), COLUMNS), ACCOUNTS), ["account_id"])
    return fold.flat(s, ["account_id"], ACCOUNTS.names).collect()


def test_latest_change_wins(spark):
    (r,) = state(spark, [change("e1", "c", "0x01"), change("e2", "u", "0x02", "80.00")])
    assert str(r["balance"]) == "80.00" and r["_event_id"] == "e2" and not r["_is_deleted"]


def test_late_change_does_not_overwrite(spark):
    (r,) = state(spark, [change("e2", "u", "0x02", "80.00")], [change("e1", "u", "0x01", "100.00")])
    assert str(r["balance"]) == "80.00"


def test_delete_is_soft_and_replay_does_not_revive(spark):
    (r,) = state(spark, [change("e1", "c", "0x01"), change("e2", "d", "0x02")], [change("e1", "c", "0x01")])
    assert r["_is_deleted"] and r["_event_id"] == "e2" and str(r["balance"]) == "100.00"


def test_first_commit_is_the_create_even_if_it_comes_late(spark):
    late = T0 + timedelta(hours=1)
    for batches in ([[change("e1", "c", "0x01", at=T0), change("e2", "u", "0x02", at=late)]], [[change("e2", "u", "0x02", at=late)], [change("e1", "c", "0x01", at=T0)]]):
        (r,) = state(spark, *batches)
        assert r["_first_commit_ts"] == T0 and r["_last_commit_ts"] == late


def test_key_only_delete_keeps_values_in_one_batch_or_two(spark):
    c, u, d = change("e1", "c", "0x01"), change("e2", "u", "0x02", "55.00"), change("e3", "d", "0x03", image=False)
    for batches in ([[c, u, d]], [[c, u], [d]], [[c], [u, d]], [[d], [u], [c]]):
        (r,) = state(spark, *batches)
        assert r["_is_deleted"] and str(r["balance"]) == "55.00"


def test_key_only_delete_of_an_unseen_row_gives_a_key_only_row(spark):
    (r,) = state(spark, [change("e9", "d", "0x09", image=False, key=7)])
    assert r["account_id"] == 7 and r["balance"] is None and r["_is_deleted"]


def test_null_values_are_not_resurrected(spark):
    (r,) = state(spark, [change("e1", "c", "0x01", status="ACTIVE"), change("e2", "u", "0x02", status=None), change("e3", "d", "0x03", image=False)])
    assert r["status"] is None


def test_equal_sequences_are_decided_by_event_id(spark):
    a, b = change("e1", "u", "0x01", "1.00"), change("e2", "u", "0x01", "2.00")
    assert {str(state(spark, x)[0]["balance"]) for x in ([a, b], [b, a])} == {"2.00"}


def test_batch_boundaries_do_not_matter(spark):
    r = random.Random(5)
    log = [change(f"e{i}", r.choice("uuudc"), f"{i:06d}", f"{i}.00", key=r.randrange(4), image=r.random() < 0.8, at=T0 + timedelta(minutes=i)) for i in range(60)]
    log = [x if x[1] == "d" or x[6] else change(x[0], x[1], x[3], key=1) for x in log]
    strip = lambda rows: sorted((x["account_id"], str(x["balance"]), x["_event_id"], x["_op"], x["_first_commit_ts"] or T0, x["_is_deleted"]) for x in rows)
    whole = strip(state(spark, log))
    for n in (2, 3):
        shuffled = log[:]
        r.shuffle(shuffled)
        assert strip(state(spark, *[shuffled[i::n] for i in range(n)], shuffled[::4])) == whole


def test_upsert_keeps_what_it_is_told_to(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id INT, v STRING, keep STRING")
    new = spark.createDataFrame([(2, "B", "Z"), (3, "c", "z")], "id INT, v STRING, keep STRING")
    got = sorted(tuple(r) for r in fold.upsert(old, new, ["id"], ["keep"]).collect())
    assert got == [(1, "a", "x"), (2, "B", "y"), (3, "c", "z")]


def brute_bursts(rows, k, w):
    out = []
    for a in sorted({r[0] for r in rows}):
        mine = sorted((int(r[2].timestamp()), r[1]) for r in rows if r[0] == a)
        starts, last = [], None
        for s, _ in mine:
            if sum(s <= t <= s + w for t, _ in mine) >= k:
                if last is None or s - last > w:
                    starts.append(s)
                last = s
        out += [(a, tuple(sorted(str(i) for t, i in mine if b <= t <= b + w))) for b in starts]
    return sorted(out)


@pytest.mark.parametrize(("k", "w", "spread"), [(3, 60, 900), (2, 10, 4000), (5, 600, 100_000), (3, 1, 200)])
def test_bursts_equal_the_definition(spark, k, w, spread):
    r = random.Random(k * w)
    rows = [(r.randrange(3), i, T0 + timedelta(seconds=r.randrange(spread))) for i in range(250)]
    df = spark.createDataFrame(rows, "a INT, i INT, ts TIMESTAMP")
    got = sorted((x["account_id"], tuple(x["evidence_keys"])) for x in rules.bursts(df, "a", "i", "ts", k, w, "r").collect())
    assert got == brute_bursts(rows, k, w)


def test_burst_window_includes_its_end(spark):
    at = lambda *s: spark.createDataFrame([(1, i, T0 + timedelta(seconds=x)) for i, x in enumerate(s)], "a INT, i INT, ts TIMESTAMP")
    assert rules.bursts(at(0, 300, 600), "a", "i", "ts", 3, 600, "r").count() == 1
    assert rules.bursts(at(0, 300, 601), "a", "i", "ts", 3, 600, "r").count() == 0


@pytest.mark.parametrize("gap", [5, 60, 3600])
def test_changes_equal_the_definition(spark, gap):
    r = random.Random(gap)
    rows = [(r.randrange(3), i, T0 + timedelta(seconds=r.randrange(gap * 60)), r.choice(["PT", "BR", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "a INT, i INT, ts TIMESTAMP, c STRING")
    got = sorted((x["account_id"], tuple(x["evidence_keys"])) for x in rules.changes_of(df, "a", "i", "ts", "c", gap, "r").collect())
    want = []
    for a in range(3):
        mine = sorted(((x[2], x[1], x[3]) for x in rows if x[0] == a), key=lambda x: x[:2])
        want += [(a, (str(p[1]), str(q[1]))) for p, q in zip(mine, mine[1:]) if p[2] and q[2] and p[2] != q[2] and int(q[0].timestamp()) - int(p[0].timestamp()) <= gap]
    assert got == sorted(want)


def test_rules_of_the_bank(spark):
    cards = [(i, 1, "PT", T0 + timedelta(minutes=i - 1)) for i in range(1, 6)] + [(10 + i, 2, "PT", T0 + timedelta(minutes=30 * i)) for i in range(5)] + [(20, 3, "PT", T0), (21, 3, "BR", T0 + timedelta(minutes=20))]
    df = spark.createDataFrame(cards, "tx_id BIGINT, account_id INT, country STRING, tx_ts TIMESTAMP").withColumn("_first_commit_ts", F.col("tx_ts"))
    v = rules.card_velocity(df).collect()
    t = rules.impossible_travel(df).collect()
    assert [(x["account_id"], x["evidence_keys"]) for x in v] == [(1, ["1", "2", "3", "4", "5"])]
    assert [(x["account_id"], x["evidence_keys"]) for x in t] == [(3, ["20", "21"])]
    a = rules.as_alerts(rules.union_rules(rules.card_velocity(df), rules.impossible_travel(df)))
    ids = {r["alert_id"] for r in a.collect()}
    assert ids == {r["alert_id"] for r in a.collect()} and len(ids) == 2 and a.where("latency_seconds is null").isEmpty()


def test_structuring_takes_live_transfers_in_the_band(spark):
    rows = [(f"T{i}", "IB1", 9000.0 if i else 9999.99, T0 + timedelta(hours=i), False) for i in range(3)] + [("T9", "IB1", 10000.0, T0, False), ("T8", "IB1", 9500.0, T0, True)]
    t = spark.createDataFrame(rows, "transfer_id STRING, debtor_iban STRING, amount DOUBLE, booking_ts TIMESTAMP, _is_deleted BOOLEAN").withColumn("_first_commit_ts", F.col("booking_ts"))
    acc = spark.createDataFrame([(5, "IB1")], "account_id INT, iban STRING")
    assert [r["evidence_keys"] for r in rules.structuring(t, acc).collect()] == [["T0", "T1", "T2"]]


def test_scores(spark):
    alerts = spark.createDataFrame([("r", ["1", "2"]), ("r", ["9"]), ("q", ["1"])], "rule STRING, evidence_keys ARRAY<STRING>")
    truth = spark.createDataFrame([("r", ["2", "3"]), ("r", ["7"]), ("p", ["1"])], "rule STRING, keys ARRAY<STRING>")
    got = {r["rule"]: r for r in quality.scores(alerts, truth).collect()}
    assert (got["r"]["precision"], got["r"]["recall"]) == (0.5, 0.5)
    assert got["q"]["recall"] is None and got["q"]["precision"] == 0.0 and got["p"]["precision"] is None and got["p"]["caught"] == 0


def test_percentiles(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "v DOUBLE")
    assert tuple(quality.percentiles(df, "v").first()) == (2.5, 3.85, 4.0)
    assert quality.percentiles(df.where("v > 9"), "v").first()["p50"] is None


def test_verdicts(spark):
    df = spark.createDataFrame([("1", "1", False), ("1", "2", False), ("1", "2", True), (None, None, False)], "a STRING, b STRING, s BOOLEAN")
    assert [r[0] for r in df.select(quality.verdict(F.col("a"), F.col("b"), F.col("s"))).collect()] == ["PASS", "FAIL", "SKIP", "PASS"]


VALUES = {
    "even": [float(i) for i in range(300)],
    "ties": [1.0] * 200 + [2.0] * 50 + [3.0],
    "wide": [(-1.0) ** i * 10.0 ** (i % 40 - 20) for i in range(250)] + [1e308, -1e308, 5e-324, 0.0, -0.0],
    "odd": [float("inf")] * 40 + [float("-inf")] * 40 + [float(i) for i in range(100)],
    "near": [1.0 + i * 2.0**-52 for i in range(120)] + [1e300],
    "one": [7.5],
    None: [float(i * i % 97) for i in range(150)],
}


@pytest.mark.parametrize("bins, limit", [(8, 5), (1024, 1 << 14)])
def test_ranks_are_selected_exactly(spark, monkeypatch, bins, limit):
    from tidemark.operators import selection

    monkeypatch.setattr(selection, "BINS", bins)
    monkeypatch.setattr(selection, "LIMIT", limit)
    df = spark.createDataFrame([(g, v) for g, vs in VALUES.items() for v in vs] + [("even", None), ("none", None)], "g STRING, v DOUBLE").repartition(3)
    wanted = spark.createDataFrame([(g, r) for g, vs in VALUES.items() for r in {0, 1, len(vs) // 3, len(vs) // 2, len(vs) - 1, len(vs), -1}] + [("none", 0), ("new", 0)], "g STRING, rank LONG")
    got = {(r["g"], r["rank"]): r["value"] for r in selection.order_statistics(df, "v", wanted, ["g"]).collect()}
    assert got == {(g, r): sorted(vs)[r] for g, vs in VALUES.items() for r in {0, 1, len(vs) // 3, len(vs) // 2, len(vs) - 1} if r < len(vs)}
    points = (0.0, 0.3, 0.5, 0.95, 1.0)
    for r in selection.percentiles(df, "v", points, ["g"]).collect():
        vs = sorted(VALUES.get(r["g"], []))
        assert r["n"] == len(vs) and len(r["values"]) == 5
        for p, x in zip(points, r["values"]):
            if not vs:
                assert x is None
                continue
            at = p * (len(vs) - 1)
            low, high = vs[int(at)], vs[-int(-at // 1)]
            assert x == low if low == high else abs(x - (low + (high - low) * (at % 1))) <= 1e-9 * max(abs(low), abs(high)) or abs(low) == float("inf") or abs(high) == float("inf")
    alone = selection.percentiles(df.where("g = 'wide'"), "v", points).first()
    assert alone["n"] == len(VALUES["wide"]) and alone["values"][2] == sorted(VALUES["wide"])[127]
    assert list(selection.percentiles(df.where("false"), "v", points).first()) == [0, [None] * 5]


def test_selection_holds_few_values(spark, monkeypatch):
    """Spark sorts no column, and all values never meet in one task."""
    from tidemark.operators import selection

    monkeypatch.setattr(selection, "LIMIT", 50)
    df = spark.range(20_000).selectExpr("pow(id, 3) as v", "id % 3 as g")
    found = selection.order_statistics(df, "v", spark.range(1).selectExpr("7000L as rank"))
    assert found.first()["value"] == 7000.0**3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "RangePartitioning" not in plan and "SinglePartition" not in plan


def test_sketches_tell_what_is_missing(spark, tmp_path):
    from tidemark.operators import set_sketch
    from tidemark.tables import Tables

    t = Tables(spark, str(tmp_path))
    ids = lambda lo, hi, *but: spark.range(lo, hi).select(F.concat(F.lit("e"), F.col("id")).alias("event_id")).where(~F.col("event_id").isin(*but) if but else F.lit(True))
    lost = lambda: sorted(r["event_id"] for r in set_sketch.missing(t, "cdc_event_audit", "bronze_change_events").collect())
    assert lost() == []
    t.append("cdc_event_audit", ids(0, 3000), batch="a")
    t.append("bronze_change_events", ids(0, 3000, "e5", "e77"), batch=0)
    assert lost() == ["e5", "e77"]
    t.append("cdc_event_audit", ids(2990, 3500), batch="b")  # ten ids were sent twice
    t.append("bronze_change_events", ids(3000, 3600, "e3001"), batch=1)  # and a hundred come from elsewhere
    assert lost() == ["e3001", "e5", "e77"]
    t.append("bronze_change_events", ids(5, 6), batch=2)
    reads = []
    real = t.read
    t.read = lambda *a, **k: reads.append(k.get("only")) or real(*a, **k)
    equal = lost()
    t.read = real
    assert equal == ["e3001", "e77"] and [r for r in reads if r] == [["batch=2"]]
    for b in range(20):  # sketches of many batches become one
        t.append("cdc_event_audit", ids(9000 + b, 9001 + b), batch=f"c{b}")
        set_sketch.Sketches(t, "cdc_event_audit").total().count()
    assert len(set_sketch.Sketches(t, "cdc_event_audit").runs.described()) < 16
    assert lost() == sorted(["e3001", "e77", *[f"e{9000 + b}" for b in range(20)]])
    t.append("cdc_event_audit", ids(20_000, 30_000), batch="d")  # too many to decode: the join
    assert len(lost()) == 10_022
    t.append("cdc_event_audit", ids(20_000, 20_001), batch="e")
    t.append("cdc_event_audit", ids(20_000, 20_001), batch="f")
    t.append("bronze_change_events", ids(20_000, 30_000), batch=3)
    assert lost() == sorted(["e3001", "e77", *[f"e{9000 + b}" for b in range(20)]])


@pytest.mark.parametrize("ours, theirs", [(0, 0), (1, 0), (900, 700), (3500, 300), (9000, 0)])
def test_decoding(spark, ours, theirs):
    from tidemark.operators import set_sketch

    cells = {}
    ids = spark.range(ours + theirs).select(F.col("id").cast("string").alias("k"), "id")
    for sign, part in ((1, ids.where(F.col("id") < ours)), (-1, ids.where(F.col("id") >= ours))):
        for r in set_sketch.sketch(part, "k").collect():
            c = cells.setdefault(r["cell"], [0, 0, 0, 0])
            c[:] = [c[0] + sign * r["n"], c[1] ^ r["x1"], c[2] ^ r["x2"], c[3] ^ r["c"]]
    got = set_sketch.decoded(cells)
    if ours == 9000:
        assert got is None
    else:
        want = [{(r["x1"], r["x2"]) for r in set_sketch.hashed(p, "k").collect()} for p in (ids.where(F.col("id") < ours), ids.where(F.col("id") >= ours))]
        assert [set(g) for g in got] == want
