"""Rules over what a batch touches against rules over everything."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import pipeline
from tidemark.operators import rules
from tidemark.streaming.silver import Entity, run_silver, view
from tidemark.tables import Tables

T0 = datetime(2026, 10, 1, 9)
ENTITIES = [
    Entity(pipeline.CARDS, "cards", ["tx_id"], "tx_id BIGINT, account_id INT, country STRING, tx_ts TIMESTAMP"),
    Entity(pipeline.TRANSFERS, "transfers", ["transfer_id"], "transfer_id STRING, debtor_iban STRING, amount DOUBLE, booking_ts TIMESTAMP"),
    Entity(pipeline.ACCOUNTS, "accounts", ["account_id"], "account_id INT, iban STRING"),
]
EVENTS = "account_id INT, item STRING, ts TIMESTAMP, value STRING"
RAW = "event_id STRING, op STRING, source_table STRING, source_sequence STRING, source_commit_ts TIMESTAMP, key_json STRING, before_json STRING, after_json STRING"


def alerts(df):
    return {(r["rule"], r["account_id"], tuple(r["evidence_keys"]), r["last_source_commit_ts"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_touched_slabs_give_all_that_changes(spark, monkeypatch, seed):
    """Rows come, go and move; slabs are short, so bursts and pairs often lie across their ends."""
    monkeypatch.setattr(rules, "SLAB", 3)
    r = random.Random(seed)
    row = lambda i: (r.randrange(4), f"i{i}", T0 + timedelta(seconds=r.randrange(6000)), r.choice("ab"))
    old = {i: row(i) for i in range(220)}
    new = dict(old)
    moved = r.sample(range(240), 25)
    for i in moved:
        if r.random() < 0.3:
            new.pop(i, None)
        else:
            new[i] = row(i)
    places = [(x[0], x[2]) for i in moved for x in (old.get(i), new.get(i)) if x]
    before, now = (spark.createDataFrame(list(x.values()), EVENTS) for x in (old, new))
    touched = spark.createDataFrame([*places, (None, T0), (1, None)], "account_id INT, ts TIMESTAMP")
    for rule in (lambda df, t=None: rules.bursts(df, "account_id", "item", "ts", 3, 60, "b", touched=t), lambda df, t=None: rules.changes_of(df, "account_id", "item", "ts", "value", 60, "c", touched=t)):
        was, full, some = alerts(rule(before)), alerts(rule(now)), alerts(rule(now, touched))
        assert full - was <= some <= full
        assert full - was and some < full
        assert not alerts(rule(now, touched.where("false")))


def raw(spark, rows):
    """rows: entity number, op, sequence, before, after."""
    out = []
    for n, op, seq, before, after in rows:
        e = ENTITIES[n]
        key = {k: (after or before)[k] for k in e.primary_key}
        out.append((f"{e.silver_table}{key}{seq}", op, e.source_table, f"{seq:06}", T0 + timedelta(seconds=seq), json.dumps(key), *(x and json.dumps(x) for x in (before, after))))
    return spark.createDataFrame(out, RAW)


@pytest.mark.parametrize("by_slabs, images", [(False, True), (True, True), (True, False)])
def test_batches_leave_what_whole_runs_leave(spark, tmp_path, by_slabs, images):
    """images: whether changes have the image before, which a polled source doesn't give; by slabs, they need none."""
    r, iso = random.Random(5), lambda s: (T0 + timedelta(seconds=s)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    card = lambda i: {"tx_id": i, "account_id": r.randrange(3), "country": r.choice(["PT", "ES"]), "tx_ts": iso(r.randrange(40_000))}
    send = lambda i: {"transfer_id": f"t{i}", "debtor_iban": f"X{r.randrange(3)}", "amount": r.choice([9500.0, 9100.0, 50.0]), "booking_ts": iso(r.randrange(900_000))}
    cards, sends = {i: card(i) for i in range(160)}, {i: send(i) for i in range(60)}
    first = [(0, "c", 1, None, c) for c in cards.values()] + [(1, "c", 1, None, t) for i, t in sends.items() if i < 40] + [(2, "c", 1, None, {"account_id": 0, "iban": "X0"})]
    moves = [(i, card(i)) for i in range(0, 160, 16)]
    second = [(0, "u", 2, cards[i], c) for i, c in moves] + [(1, "c", 2, None, t) for i, t in sends.items() if i >= 40] + [(2, "c", 2, None, {"account_id": 1, "iban": "X1"})]
    third = [(1, "d", 3, sends[i], None) for i in (1, 41)] + [(2, "u", 3, {"account_id": 1, "iban": "X1"}, {"account_id": 1, "iban": "X2"}), (2, "u", 3, {"account_id": 0, "iban": "X0"}, {"account_id": 0, "iban": "X0"})]
    by_batch, whole = (Tables(spark, str(tmp_path / n)) for n in ("by_batch", "whole"))
    found = []
    for i, rows in enumerate((first, second, third)):
        for t in (by_batch, whole):
            t.ensure()
            events = raw(spark, rows)
            t.append("bronze_change_events", events if images else events.withColumn("before_json", F.when(F.col("op") == "d", F.col("before_json"))), batch=i)
            gold = pipeline.GoldBySlabs(t, ENTITIES, 4) if by_slabs else None
            hooks = {} if t is whole else {"before": gold.before, "after": gold.after} if by_slabs else {"after": pipeline.gold_after(t, ENTITIES)}
            run_silver(t, ENTITIES, f"{tmp_path}/ck-{t.root[-5:]}", **hooks)
        pipeline.run_gold(whole, *[view(whole, e) for e in ENTITIES])
        a, b = (alerts(t.read("gold_fraud_alerts")) for t in (by_batch, whole))
        assert a == b
        found.append(a)
    assert {x[0] for x in found[2]} == {"card_velocity", "impossible_travel", "structuring"} and found[0] < found[1] | found[0] and found[2] - found[1]


def test_a_change_of_an_account_that_keeps_its_iban_touches_nothing(spark):
    batch = raw(spark, [(2, "u", 1, {"account_id": 0, "iban": "X0"}, {"account_id": 0, "iban": "X0"})])
    transfers = spark.createDataFrame([("t1", "X0", 9500.0, T0)], "transfer_id STRING, debtor_iban STRING, amount DOUBLE, booking_ts TIMESTAMP")
    accounts = spark.createDataFrame([(0, "X0")], "account_id INT, iban STRING")
    t = pipeline.touched_moments(batch, {e.source_table: e for e in ENTITIES}, transfers, accounts)
    assert t["cards"].count() == t["transfers"].count() == 0
    new = pipeline.touched_moments(batch.withColumn("before_json", F.lit(None).cast("string")), {e.source_table: e for e in ENTITIES}, transfers, accounts)
    assert [tuple(x) for x in new["transfers"].collect()] == [(0, T0)]


def test_slabs_choose_what_is_read(spark, tmp_path):
    """Moved, deleted and new rows lie where they are now; a batch that is given again changes nothing and still knows where rows were."""
    from tidemark.streaming import slabs
    from tidemark.streaming.silver import apply_batch

    t, e = Tables(spark, str(tmp_path), buckets=32), ENTITIES[0]
    index = slabs.Slabs(e, "account_id", "tx_ts", 3600, 2)
    iso = lambda h: (T0 + timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    card = lambda i, h, who: {"tx_id": i, "account_id": who, "country": "PT", "tx_ts": iso(h)}
    first = raw(spark, [(0, "c", 1, None, card(i, i, i % 3)) for i in range(60)])
    index.merge(t, slabs.noted(t, first, e, 0))
    apply_batch(t, first, e)
    moves = {3: 40, 4: 4, 59: 0}
    second = raw(spark, [(0, "u", 2, None, card(i, h, 2)) for i, h in moves.items()] + [(0, "c", 2, None, card(99, 7, 1)), (0, "c", 2, None, card(98, 7, None))])
    for stored in (False, True, True):  # it fails before the state is stored, then behind
        changed = slabs.noted(t, second, e, 1)
        index.merge(t, changed)
        if stored:
            apply_batch(t, second, e)
        places = {(r["account_id"], r["tx_ts"]) for r in slabs.images(changed, "account_id", "tx_ts").collect()}
        assert {(i % 3, T0 + timedelta(hours=i)) for i in moves} | {(2, T0 + timedelta(hours=h)) for h in moves.values()} <= places
    now = {i: (moves.get(i, i), 2 if i in moves else i % 3) for i in range(60)} | {99: (7, 1)}
    lie = {r["tx_id"]: (r["__slab"] - int(T0.timestamp()) // 3600, r["account_id"]) for r in t.read(index.name).collect()}
    assert lie == now
    moments = spark.createDataFrame([(2, T0 + timedelta(hours=40)), (None, T0), (1, None)], "owner INT, ts TIMESTAMP")
    got = index.around(t, moments, 3600)
    assert {r["tx_id"] for r in got.collect()} == {i for i, (h, who) in now.items() if who == 2 and 39 <= h <= 41}
    assert len(got.inputFiles()) <= 3 < len(t.read(index.name).inputFiles())
    assert {r["tx_id"] for r in index.of_owners(t, spark.createDataFrame([(1,)], "account_id INT")).collect()} == {i for i, (_, who) in now.items() if who == 1}
    assert "_first_commit_ts" in got.columns and "__slab" not in got.columns


def test_totals_follow_the_state(spark, tmp_path, monkeypatch):
    """Late rows, deletes, rows that come again, and a batch that fails behind its state and is given again."""
    from tidemark.streaming import totals

    monkeypatch.setattr(totals, "FOLDERS", 3)
    t, e, r = Tables(spark, str(tmp_path)), Entity("dbo.accounts", "accounts", ["account_id"], "account_id INT, balance DECIMAL(18,2)"), random.Random(2)
    t.ensure()
    kept = totals.Totals(t, [e])
    assert kept.read(e) == {"rows": 0, "balance": None} or kept.read(e)["rows"] == 0
    fails = []

    def after(_):
        if fails:
            fails.pop()
            raise RuntimeError("lost after storing")

    for b in range(6):
        out = []
        for _ in range(40):
            i, op, seq = r.randrange(30), r.choice("ccuud"), r.randrange(50)
            image = json.dumps({"account_id": i, "balance": r.randrange(10_000) / 100})
            out.append((f"{b}-{i}-{op}-{seq}-{r.random()}", op, e.source_table, f"{seq:06}", T0, json.dumps({"account_id": i}), None, None if op == "d" else image))
        t.append("bronze_change_events", spark.createDataFrame(out, RAW), batch=b)
        if b == 3:
            fails.append(1)
            with pytest.raises(Exception, match="lost after storing"):
                run_silver(t, [e], f"{tmp_path}/ck", after, kept.before)
        run_silver(t, [e], f"{tmp_path}/ck", after, kept.before)
        assert kept.read(e) == kept.counted(e)
    assert kept.read(e)["rows"] > 5 and len(kept._runs(e).described()) <= 4


def test_a_batch_of_latest_state_stays_out_of_the_cache(spark, tmp_path):
    """It is read from files, which are there as long as its hooks run."""
    t, seen = Tables(spark, str(tmp_path), buckets=2), []
    cache = spark._jsparkSession.sharedState().cacheManager()
    spark.catalog.clearCache()
    noted = lambda batch, *name: seen.append((batch.count(), cache.isEmpty()))
    t.append("bronze_change_events", raw(spark, [(2, "c", 1, None, {"account_id": i, "iban": f"X{i}"}) for i in range(9)]), batch=0)
    run_silver(t, ENTITIES, f"{tmp_path}/ck", noted, noted)
    assert seen == [(9, True), (9, True)] and view(t, ENTITIES[2]).count() == 9
    assert t.files.names(f"{t.path('bronze_change_events')}__folded") == []


def test_rows_before_and_after_a_batch_come_from_one_aggregation(spark, tmp_path):
    """No joins of the state with the batch's keys and with itself; keys that the batch doesn't have aren't given."""
    from tidemark.streaming import slabs
    from tidemark.streaming.silver import apply_batch

    t, e = Tables(spark, str(tmp_path), buckets=2), ENTITIES[2]
    apply_batch(t, raw(spark, [(2, "c", 1, None, {"account_id": i, "iban": f"X{i}"}) for i in range(9)]), e)
    second = raw(spark, [(2, "u", 2, None, {"account_id": 3, "iban": "Y"}), (2, "c", 2, None, {"account_id": 20, "iban": "Z"})])
    found = slabs.changes(t, second, e)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    was = {(r["now"]["account_id"], r["now"]["iban"]): r["was"] and r["was"]["iban"] for r in found.collect()}
    assert was == {(3, "Y"): "X3", (20, "Z"): None}
