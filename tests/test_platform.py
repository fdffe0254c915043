"""Tables, topics, configuration, simulator, and the query catalogue."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import config
from tidemark.simulate import Bank, pt_iban
from tidemark.streaming.topic_log import DeliveryError, TopicLog, kafka_append, kafka_options, kafka_producer_options
from tidemark.tables import Tables


def messages(spark, n, start=0):
    return spark.range(start, start + n).select(F.concat(F.lit("k"), (F.col("id") % 5).cast("string")).alias("key"), F.col("id").cast("string").alias("value"), F.create_map(F.lit("h"), F.lit("1")).alias("headers"))


def valid(spark, lo, hi):
    """Messages of well-formed create events."""
    i = F.col("id").cast("string")
    source = F.struct(F.lit("shop").alias("system"), F.lit("db").alias("database"), F.lit("t").alias("table"), i.alias("position"))
    event = F.struct(F.sha2(i, 256).alias("event_id"), F.lit("c").alias("op"), F.struct("id").alias("key"), F.struct("id").alias("after"), source.alias("source"), F.lit("2024-01-01T00:00:00").alias("captured_at"), F.lit("t").alias("trace_id"), F.lit(1).alias("schema_version"), F.sha2(F.lit("p"), 256).alias("payload_hash"))
    return spark.range(lo, hi).select(i.alias("key"), F.to_json(event).alias("value"), F.create_map(F.lit("h"), F.lit("1")).alias("headers"))


def test_topics(spark, tmp_path):
    t = TopicLog(spark, str(tmp_path))
    assert t.ensure(["a", "b"]) == ["a", "b"] and t.ensure(["a", "b", "c"]) == ["c"]
    t.append("a", messages(spark, 20), ["value"])
    t.append("a", messages(spark, 10, 20), ["value"])
    rows = t.read("a").collect()
    assert len(rows) == 30
    for p in {r["partition"] for r in rows}:
        mine = sorted(r["offset"] for r in rows if r["partition"] == p)
        assert mine == list(range(len(mine)))
    assert all(len({r["partition"] for r in rows if r["key"] == f"k{k}"}) == 1 for k in range(5))
    with pytest.raises(DeliveryError):
        t.append("missing", messages(spark, 1), ["value"])
    assert t.read("b").count() == 0


def test_a_lost_race_leaves_offsets_gapless(spark, tmp_path, monkeypatch):
    a, b = TopicLog(spark, str(tmp_path)), TopicLog(spark, str(tmp_path))
    a.ensure(["t"])
    rename, raced = a.files.rename, []

    def late(x, y):
        if not raced:
            raced.append(b.append("t", messages(spark, 7, 100), ["value"]).count())  # another writer is first, under the same number
        return rename(x, y)

    monkeypatch.setattr(a.files, "rename", late)
    a.append("t", messages(spark, 9), ["value"])
    b.append("t", messages(spark, 5, 200), ["value"])
    rows = b.read("t").collect()
    assert len(rows) == 21 and raced == [7]
    for p in {r["partition"] for r in rows}:
        mine = sorted(r["offset"] for r in rows if r["partition"] == p)
        assert mine == list(range(len(mine)))


def test_a_repeated_step_writes_once(spark, tmp_path):
    t = TopicLog(spark, str(tmp_path))
    t.ensure(["t"])
    assert t.append("t", messages(spark, 3), ["value"], once=("w", 0)).count() == 3
    t.append("t", messages(spark, 2, 50), ["value"])
    assert t.append("t", messages(spark, 3), ["value"], once=("w", 0)).count() == 0
    assert t.append("t", messages(spark, 4), ["value"], once=("w", 1)).count() == 4 and t.read("t").count() == 9


def test_bad_events_reach_the_dead_letter_topic_once(spark, tmp_path):
    from tidemark.streaming.bronze import run_bronze

    tables, t = Tables(spark, f"{tmp_path}/tables"), TopicLog(spark, f"{tmp_path}/topics")
    tables.ensure()
    t.ensure(["in", "dead"])
    t.append("in", messages(spark, 6), ["value"])
    append = tables.append
    tables.append = lambda *a, **k: append(*a, **k)
    real = t.append

    def fails_after(topic, *a, **k):
        real(topic, *a, **k)
        raise RuntimeError("lost after writing")

    t.append = fails_after
    with pytest.raises(Exception, match="lost after writing"):
        run_bronze(tables, t, ["in"], f"{tmp_path}/ck", "dead")
    t.append = real
    run_bronze(tables, t, ["in"], f"{tmp_path}/ck", "dead")  # the same batch again
    assert t.read("dead").count() == 6


def test_object_stores_are_refused(spark):
    from tidemark.files import Files

    f = Files(spark)
    p = spark._jvm.org.apache.hadoop.fs.Path("s3a://bucket/x")
    with pytest.raises(OSError, match="no atomic rename"):
        f._rename(p, p, "NONE")


def test_tables(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    assert t.ensure() and t.ensure() == []
    assert t.read("cdc_control").count() == 0 and not t.exists("cdc_control")
    row = lambda n, w: spark.createDataFrame([(n, w, "t", 1, 0, "OK", "2026-10-01T09:00:00")], "source_name STRING, watermark STRING, last_trace_id STRING, events_captured INT, rejects INT, status STRING, updated_at STRING")
    for n, w in (("a", "1"), ("b", "1"), ("a", "2"), ("a", "3")):
        t.upsert("cdc_control", row(n, w), ["source_name"])
    assert sorted((r["source_name"], r["watermark"]) for r in t.read("cdc_control").collect()) == [("a", "3"), ("b", "1")]
    assert len([n for n in t.files.names(t.path("cdc_control")) if n.startswith("v=")]) == 2
    a = spark.createDataFrame([("x",)], "event_id STRING")
    t.append("bronze_change_events", a, batch=0)
    t.append("bronze_change_events", a, batch=0)
    assert t.read("bronze_change_events").count() == 1 and t.read("bronze_change_events", but_batch=0).count() == 0


def test_kafka_options():
    assert kafka_options({"bootstrap.servers": "h:1"}) == {"kafka.bootstrap.servers": "h:1"}
    sure = kafka_producer_options({"bootstrap.servers": "h:1"})
    assert sure["kafka.acks"] == "all" and sure["kafka.enable.idempotence"] == "true"
    o = kafka_options({"bootstrap.servers": "h:1", "security.protocol": "SASL_SSL", "sasl.username": "u", "sasl.password": "p"}, shaded=True)
    assert o["kafka.sasl.jaas.config"].startswith("kafkashaded.") and 'username="u"' in o["kafka.sasl.jaas.config"]


def test_a_broker_that_cannot_be_written_to_is_a_delivery_error(spark):
    with pytest.raises(DeliveryError, match="t: "):
        kafka_append(messages(spark, 1), kafka_producer_options({"bootstrap.servers": "127.0.0.1:1"}), "t")


def test_configuration(monkeypatch):
    cfg = config.load()
    assert config.topics_of(cfg["sources"]["sqlserver_cards"])["dbo.accounts"] == "banking.cdc.cards.accounts"
    assert config.topics_of(cfg["sources"]["partner_fileshare"]) == {"partner_transfers": "banking.cdc.partner.transfers"}
    assert len(config.all_entities(cfg)) == 5 and len(config.all_topics(cfg)) == 7
    monkeypatch.setenv("MSSQL_CARDS_HOST", "h")
    assert config.environment("mssql-cards", "host") == "h"
    with pytest.raises(KeyError, match="MSSQL_CARDS_PORT"):
        config.environment("mssql-cards", "port")
    with pytest.raises(ValueError, match="unknown source type"):
        config.build_source(None, {"sources": {"x": {"type": "?", "connection_secret": "k"}}}, "x")
    secrets = {"bootstrap": "b", "api_key": "u", "api_secret": "p"}
    assert config.broker(lambda k, f: secrets[f])["sasl.username"] == "u"
    del secrets["api_key"]
    assert config.broker(lambda k, f: secrets[f]) == {"bootstrap.servers": "b"}


def bank(seed):
    b = Bank(seed, datetime(2026, 10, 1), customers=15, card_payments=30, transfers=6)
    b.open()
    for _ in range(4):
        b.hour()
    return b


def test_simulator_follows_its_seed():
    a, b, c = bank(1), bank(1), bank(2)
    assert a.log == b.log and a.files == b.files and a.loans == b.loans and a.truth == b.truth
    assert a.log != c.log


def test_simulator_is_consistent():
    b = bank(3)
    assert {t["rule"] for t in b.truth} == {"card_velocity", "impossible_travel", "structuring"}
    state = {}
    for c in b.log:
        key = (c.table, c.row[Bank._keys[c.table]])
        if c.code == 1:
            assert state.pop(key) == c.row
        elif c.code == 3:
            assert state[key] == c.row
        else:
            state[key] = c.row
    assert state == {(t, k): r for t, rows in b.tables.items() for k, r in rows.items()}
    iban = pt_iban("0033000000000000001")
    assert iban.startswith("PT50") and int("".join(str(int(ch, 36)) for ch in iban[4:] + iban[:4])) % 97 == 1


def test_the_log_can_be_carried_out_on_a_database():
    import sqlite3
    from decimal import Decimal

    from tidemark import seeding

    b = bank(4)
    con = sqlite3.connect(":memory:")
    adapt = lambda v: str(v) if isinstance(v, Decimal | datetime) or hasattr(v, "isoformat") else v
    for t, rows in b.tables.items():
        con.execute(f"create table {t} ({', '.join(next(iter(rows.values())))})")
    assert seeding.apply_log(con, b.log, adapt, every=7) == sum(c.code != 3 for c in b.log)
    for t, rows in b.tables.items():
        assert sorted(con.execute(f"select * from {t}").fetchall()) == sorted(tuple(map(adapt, r.values())) for r in rows.values())
    con.execute(f"create table loans ({', '.join(next(iter(b.loans.values())))})")
    for _ in range(2):
        seeding.replace_rows(con, "loans", "LOAN_ID", b.loans, adapt)
        assert sorted(con.execute("select * from loans").fetchall()) == sorted(tuple(map(adapt, r.values())) for r in b.loans.values())
        b.hour()


def test_heartbeat_waits_and_gives_up():
    from tidemark import seeding

    now = [0.0]
    sleep = lambda s: now.__setitem__(0, now[0] + s)
    assert seeding.heartbeat(lambda: 7, lambda t: t == 7 and now[0] >= 3, clock=lambda: now[0], sleep=sleep) == 3
    with pytest.raises(seeding.NotCaptured):
        seeding.heartbeat(lambda: 7, lambda t: False, clock=lambda: now[0], sleep=sleep)


SMALL = "/root/testdata/sf0.001"


def test_catalogue_equals_its_sql(spark):
    import os

    import duckdb

    from tidemark.plans.catalog import ORACLE, QUERIES

    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{SMALL}/{f}')")
    shown = lambda rows, at: sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in (r[i] for i in at)) for r in rows)
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, SMALL)
        got = con.execute(sql)
        names = [d[0] for d in got.description]
        assert sorted(df.columns) == sorted(names), name
        cols = sorted(names)
        assert shown(df.collect(), [df.columns.index(c) for c in cols]) == shown(got.fetchall(), [names.index(c) for c in cols]), name


def test_lineage_reaches_every_alert(spark):
    from pyspark.sql import functions as F

    from tidemark.plans.catalog import QUERIES

    alerts = QUERIES["card_velocity_burst"](spark, SMALL).select(F.split("evidence", ",").alias("keys"), "account_id").collect()
    rows = QUERIES["lineage_explode"](spark, SMALL).collect()
    assert any(r["account_id"] % 50 for r in alerts) and len({r["alert_id"] for r in rows}) == len(alerts)
    assert sorted(r["entity_key"] for r in rows) == sorted(k for r in alerts for k in r["keys"])


def test_manifests_count_every_order(spark):
    from tidemark.plans.catalog import QUERIES

    n = spark.read.parquet(f"{SMALL}/orders.parquet").count()
    rows = QUERIES["file_manifest_counts"](spark, SMALL).collect()
    assert n > 500 and sum(r["rows"] + r["rejected"] for r in rows) == n and all(r["rows"] + r["rejected"] <= 1000 for r in rows)


def test_every_order_becomes_an_update_pair(spark):
    from tidemark.plans.catalog import QUERIES

    keys = {r["o_orderkey"] for r in spark.read.parquet(f"{SMALL}/orders.parquet").select("o_orderkey").collect()}
    rows = QUERIES["log_update_pairs"](spark, SMALL).collect()
    assert len(rows) == len(keys) and {int(r["position"].split(":")[1]) for r in rows} == keys
    assert all(r["op"] == "u" and abs(r["after_price"] - r["before_price"] - 1) < 1e-6 for r in rows)


def test_a_merge_writes_the_buckets_it_touches(spark, tmp_path):
    from pyspark.sql import functions as F

    t = Tables(spark, str(tmp_path), buckets=8)
    rows = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    newest = lambda old, new: new if old is None else old.join(new, "k", "left_anti").unionByName(new)
    t.merge("s", rows(0, 0, "none"), ["k"], newest)
    assert not t.exists("s")  # no rows, nothing written
    t.merge("s", rows(0, 1000, "a"), ["k"], newest)
    first = t._manifest("s")["at"]
    assert len(first) == 8 and t.read("s").count() == 1000
    reader = t.read("s")
    t.merge("s", rows(7, 8, "b"), ["k"], newest)
    second = t._manifest("s")["at"]
    assert sum(first[b] != second[b] for b in first) == 1
    assert reader.where("v = 'a'").count() == 1000  # began before, reads on
    assert {r["k"]: r["v"] for r in t.read("s").collect()} == {k: "b" if k == 7 else "a" for k in range(1000)}
    one = rows(7, 8, "?").select(F.col("k").cast("int"))  # the same bucket whatever the type of the key
    near = t.lookup("s", one, ["k"])
    assert near.where("k = 7").count() == 1 and near.count() < 1000
    t.merge("s", rows(7, 8, "c"), ["k"], newest)
    gone = t._manifest("s")["before"]
    assert len(gone) == 1 and first[gone[0].split("=")[-1]].startswith("v=0") and not t.files.exists(f"{t.path('s')}/v=0/__bucket={gone[0].split('=')[-1]}")
    t.merge("s", rows(0, 1000, "x"), ["k"], lambda old, new: old.where("false"))
    assert t.read("s").count() == 0 and t.read("s").columns == ["k", "v"]
    t.merge("s", rows(5, 6, "d"), ["k"], newest)
    assert [tuple(r) for r in t.read("s").collect()] == [(5, "d")]


def test_buckets_double_as_they_grow(spark, tmp_path):
    from pyspark.sql import functions as F

    t = Tables(spark, str(tmp_path), buckets=2, bucket_bytes=2000)
    add = lambda old, new: new if old is None else old.unionByName(new)
    for step in range(3):
        t.merge("s", spark.range(step * 2000, step * 2000 + 2000).select(F.col("id").alias("k")), ["k"], add)
    m = t._manifest("s")
    assert m["buckets"] >= 8 and len(m["at"]) == m["buckets"]
    assert sorted(r["k"] for r in t.read("s").collect()) == list(range(6000))
    t.replace("s", spark.range(10).select(F.col("id").alias("k")), ["k"])
    assert t.read("s").count() == 10 and t._manifest("s")["buckets"] == m["buckets"]


def test_rows_that_change_between_two_reads_harm_no_other_bucket(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    t = Tables(spark, str(tmp_path), buckets=4)
    newest = lambda old, new: new if old is None else old.join(new, "k", "left_anti").unionByName(new)
    rows = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("k"))
    t.merge("s", rows(0, 100), ["k"], newest)
    seen = t._touched(t._manifest("s"), rows(3, 4), ["k"], 4)
    monkeypatch.setattr(t, "_touched", lambda *a: seen)  # as if the first read had given one row only
    t.merge("s", rows(0, 100), ["k"], newest)
    assert sorted(r["k"] for r in t.read("s").collect()) == list(range(100))


def test_stored_events_are_not_shuffled_for_a_small_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidemark.streaming.bronze import new_rows

    spark.range(100_000).select(F.col("id").cast("string").alias("event_id")).write.parquet(f"{tmp_path}/have")
    batch = spark.createDataFrame([(str(i),) for i in (5, 5, 100_001, 100_001)], "event_id STRING").persist()
    batch.count()
    got = new_rows(batch, spark.read.parquet(f"{tmp_path}/have"))
    assert [r["event_id"] for r in got.collect()] == ["100001"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    semi = next(line for line in plan.splitlines() if "LeftSemi" in line)
    assert "BroadcastHashJoin" in semi


def _keys(t, name="s"):
    return sorted(r["k"] for r in t.read(name).collect())


def test_merges_that_race_lose_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    a, b = (Tables(spark, str(tmp_path), buckets=2) for _ in range(2))
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k INT")
    newest = lambda old, new: new if old is None else old.join(new, "k", "left_anti").unionByName(new)
    tries = []

    def slowly(*others):
        def how(old, new):
            tries.append(others)
            if len(tries) == 1:
                for ks in others:
                    b.merge("s", rows(*ks), ["k"], newest)
            return newest(old, new)

        return how

    for before, mine, others, again in (((), (9,), ((8,),), 2), ((1,), (3,), ((2,),), None), ((), tuple(range(40)), ((41,), (42,), (43,)), 2)):
        a.merge("s", rows(*before), ["k"], newest)
        had = _keys(a) if a.exists("s") else []
        tries.clear()
        a.merge("s", rows(*mine), ["k"], slowly(*others))
        assert _keys(b) == sorted({*had, *mine, *[k for ks in others for k in ks]})
        assert again is None or len(tries) == again
    # buckets that nobody else touched follow upon the manifest that won, without another try
    at = {k: a._touched(a._manifest("s"), rows(k), ["k"], 2)[0] for k in (1, 2, 3, 8, 9)}
    one, other = next((x, y) for x in at for y in at if at[x] != at[y])
    tries.clear()
    stamped = lambda old, _: old.withColumn("k", F.col("k"))
    a.merge("s", rows(one), ["k"], lambda old, new: (tries.append(1), b.merge("s", rows(other), ["k"], newest), newest(old, new))[2])
    assert len(tries) == 1 and {one, other} <= set(_keys(a))
    a.merge("s", rows(one), ["k"], stamped)
    used = {f.split("/")[0] for m in (a._manifest("s"),) for f in [*m["at"].values(), *m["before"]]}
    assert {n for n in a.files.names(a.path("s")) if n.startswith("v=")} == used


def test_two_processes_keep_every_decision(spark, tmp_path):
    import os
    import subprocess
    import sys

    from tidemark.service import AlertStore

    t = Tables(spark, str(tmp_path), buckets=2)
    t.ensure()
    store = AlertStore(t)
    ids = [f"a{i}" for i in range(12)]
    alert = "alert_id STRING, rule STRING, account_id INT, evidence_keys ARRAY<STRING>, first_evidence_ts STRING, last_source_commit_ts STRING, alert_created_at STRING, latency_seconds DOUBLE"
    row = lambda i, *keys: (i, "r", 1, list(keys), "t", "t", "t", 1.0)
    store.upsert(spark.createDataFrame([row(i, "1") for i in ids], alert))
    code = f"""
from pyspark.sql import SparkSession
from tidemark.service import AlertStore
from tidemark.tables import Tables
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
store = AlertStore(Tables(spark, {str(tmp_path)!r}, buckets=2))
print("ready", flush=True)
for i in {ids[::2]!r}:
    store.set_status(i, "CONFIRMED", "theirs")
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    other = subprocess.Popen([sys.executable, "-c", code], env=os.environ | {"PYTHONPATH": root}, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True)
    while "ready" not in (line := other.stdout.readline()):
        assert line or other.poll() is None
    for k, i in enumerate(ids[1::2]):
        store.set_status(i, "DISMISSED", "ours")
        store.upsert(spark.createDataFrame([row(x, "1", str(k)) for x in ids], alert))
    assert other.wait(timeout=120) == 0
    got = {r["alert_id"]: (r["status"], r["note"], r["evidence_keys"]) for r in t.read(store.table).collect()}
    assert got == {i: (*(("DISMISSED", "ours") if k % 2 else ("CONFIRMED", "theirs")), ["1", "5"]) for k, i in enumerate(ids)}


def test_batches_that_cannot_hold_an_id_are_not_opened(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidemark.streaming.stored_ids import StoredIds

    t = Tables(spark, str(tmp_path))
    ids = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit("e"), F.col("id")).alias("event_id"))
    stored = StoredIds(t, "bronze_change_events")
    opened = lambda df: {f.split("/batch=")[1].split("/")[0] for f in df.inputFiles()}
    assert stored.known(ids(0, 5)).count() == 0
    for b in range(4):
        t.append("bronze_change_events", ids(100 * b, 100 * b + 100), batch=b)
        stored.add(b)
    assert opened(stored.known(ids(1000, 2000))) == set()  # all new
    assert opened(stored.known(ids(150, 160))) == {"1"}  # a replay
    assert opened(stored.known(ids(150, 160), but_batch=1)) == set()
    assert opened(stored.known(ids(150, 250).union(ids(7, 8)))) == {"0", "1", "2"}
    t.append("bronze_change_events", ids(5000, 5001), batch="by-other-means")
    assert opened(stored.known(ids(1000, 2000))) == {"by-other-means"}
    stored.forget(2)
    assert opened(stored.known(ids(1000, 2000))) == {"2", "by-other-means"}
    assert stored.known(ids(1000, 2000)).columns == t.read("bronze_change_events").columns


def test_bronze_opens_what_it_must(spark, tmp_path, monkeypatch):
    """Events that come again in a later micro-batch, and a batch that is repeated whole, are stored once."""
    from tidemark.streaming import bronze, stored_ids

    tables, topics = Tables(spark, f"{tmp_path}/t"), TopicLog(spark, f"{tmp_path}/topics")
    tables.ensure()
    topics.ensure(["a"])
    seen, real = [], stored_ids.StoredIds.may_hold

    def noted(self, ids, but_batch=None):
        seen.append(real(self, ids, but_batch))
        return seen[-1]

    monkeypatch.setattr(stored_ids.StoredIds, "may_hold", noted)
    for lo, hi in ((0, 3), (3, 6), (1, 2), (6, 9)):
        topics.append("a", valid(spark, lo, hi), ["key"])
        bronze.run_bronze(tables, topics, ["a"], f"{tmp_path}/ck")
    assert seen == [[], [], ["batch=0"], []]
    assert tables.read("bronze_change_events").count() == 9 == tables.read("bronze_change_events").select("event_id").distinct().count()


def test_lineage_reads_the_batches_that_hold_its_keys(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidemark.operators import quality
    from tidemark.streaming.postings import Postings

    t = Tables(spark, str(tmp_path))
    sources = {"r": ("cards", "tx_id"), "s": ("sends", "id")}
    postings = Postings(t, set(sources.values()))
    raw = lambda lo, hi, table, key: spark.range(lo, hi).select(F.concat(F.lit(table), F.col("id")).alias("event_id"), F.lit("c").alias("op"), F.lit(table).alias("source_table"), F.to_json(F.struct(F.col("id").alias(key))).alias("key_json"))
    for b in range(6):
        t.append("bronze_change_events", raw(10 * b, 10 * b + 10, "cards", "tx_id").unionByName(raw(0, 3, "sends", "id") if b == 2 else raw(0, 1, "accounts", "tx_id")), batch=b)
        postings.add(b)
    alerts = spark.createDataFrame([("a", "r", ["3", "4", "41"]), ("b", "s", ["1"]), ("c", "other", ["30"])], "alert_id STRING, rule STRING, evidence_keys ARRAY<STRING>")
    folders = lambda: postings.holding(quality.evidence(alerts, sources))
    found = lambda: sorted((r["alert_id"], r["event_id"]) for r in postings.lineage(alerts, sources).collect())
    want = [("a", "cards3"), ("a", "cards4"), ("a", "cards41"), ("b", "sends1")]
    assert folders() == ["batch=0", "batch=2", "batch=4"] and found() == want
    postings.merge(3)
    assert len(postings.runs.described()) == 1 and folders() == ["batch=0", "batch=2", "batch=4"] and found() == want
    t.append("bronze_change_events", raw(3, 5, "cards", "tx_id"), batch=9)  # without postings: read in any case
    assert folders() == ["batch=0", "batch=2", "batch=4", "batch=9"]
    postings.add(9)
    assert folders() == ["batch=0", "batch=2", "batch=4", "batch=9"] and len(found()) == 6
    postings.forget(9)
    t.append("bronze_change_events", raw(100, 101, "cards", "tx_id"), batch=9)
    postings.add(9)
    assert folders() == ["batch=0", "batch=2", "batch=4"] and found() == want
    opened = postings.lineage(alerts.where("rule = 'r'"), sources).inputFiles()
    assert {f.split("/batch=")[1].split("/")[0] for f in opened} == {"0", "4"}


def test_counts_of_a_repeated_batch_stand(spark, tmp_path, monkeypatch):
    """The consumer fails after its alerts are stored: the batch that is given again is counted as it was."""
    from tidemark.service import AlertStore
    from tidemark.streaming import queue

    tables, topics = Tables(spark, f"{tmp_path}/t"), TopicLog(spark, f"{tmp_path}/topics")
    tables.ensure()
    topics.ensure(["alerts"])
    store = AlertStore(tables)
    alert = F.to_json(F.struct(F.concat(F.lit("a"), F.col("id")).alias("alert_id"), F.lit("r").alias("rule"), F.lit(1).alias("account_id"), F.array(F.lit("k")).alias("evidence_keys")))
    rows = spark.range(5).select(F.col("id").cast("string").alias("key"), F.when(F.col("id") < 4, alert).otherwise("no json").alias("value"), F.create_map(F.lit("h"), F.lit("1")).alias("headers"))
    topics.append("alerts", rows.union(rows.where("key = '0'")), ["key"])
    upsert = AlertStore.upsert

    def fails_after(self, *a, **k):
        upsert(self, *a, **k)
        raise RuntimeError("lost after storing")

    monkeypatch.setattr(AlertStore, "upsert", fails_after)
    with pytest.raises(Exception, match="lost after storing"):
        queue.consume(store, topics, "alerts", f"{tmp_path}/ck")
    monkeypatch.setattr(AlertStore, "upsert", upsert)
    assert queue.consume(store, topics, "alerts", f"{tmp_path}/ck") == {"stored": 4, "duplicate": 1, "rejected": 1}
    topics.append("alerts", rows.where("key < '2'"), ["key"])
    assert queue.consume(store, topics, "alerts", f"{tmp_path}/ck") == {"stored": 0, "duplicate": 2, "rejected": 0}
    assert queue.totals(store, f"{tmp_path}/ck") == {"stored": 4, "duplicate": 3, "rejected": 1} and tables.read(store.table).count() == 4


def test_walking_pages_gives_each_alert_once(spark, tmp_path):
    """While others arrive and statuses change; without a time, alerts come last."""
    from tidemark.service import AlertStore, answer

    t = Tables(spark, str(tmp_path), buckets=2)
    t.ensure()
    store = AlertStore(t)
    alert = "alert_id STRING, rule STRING, account_id INT, evidence_keys ARRAY<STRING>, first_evidence_ts STRING, last_source_commit_ts STRING, alert_created_at STRING, latency_seconds DOUBLE"
    row = lambda i, at: (f"a{i:02}", "r", 1, ["k"], "t", "t", at, 1.0)
    store.upsert(spark.createDataFrame([row(i, f"2026-01-0{1 + i % 3}" if i % 5 else None) for i in range(20)], alert))
    seen, after = [], ""
    while True:
        status, page = answer(store, "GET", f"/alerts?limit=6{after}")
        assert status == 200
        seen += [p["alert_id"] for p in page]
        if len(page) < 6:
            break
        after = f"&after={page[-1]['alert_id']}"
        if len(seen) == 6:
            store.upsert(spark.createDataFrame([row(50, "2026-02-01")], alert))  # newer than what was seen
            store.set_status(seen[0], "CONFIRMED")
    order = sorted(range(20), key=lambda i: (-(1 + i % 3) if i % 5 else 0, i))
    assert seen == [f"a{i:02}" for i in order]
    assert answer(store, "GET", "/alerts?after=none")[0] == 422


def test_a_walk_of_the_queue_scans_it_once(spark, tmp_path):
    """Page numbers are those of pages that go on behind each other's last row, and the jobs don't grow with the pages."""
    from tidemark.service import AlertStore

    t = Tables(spark, str(tmp_path), buckets=2)
    t.ensure()
    store = AlertStore(t)
    alert = "alert_id STRING, rule STRING, account_id INT, evidence_keys ARRAY<STRING>, first_evidence_ts STRING, last_source_commit_ts STRING, alert_created_at STRING, latency_seconds DOUBLE"
    rows = [(f"a{i:02}", "r" if i % 4 else "other", 1, ["k"], "t", "t", f"2026-01-0{1 + i % 3}" if i % 5 else None, 1.0) for i in range(40)]
    assert store.upsert(spark.createDataFrame(rows, alert), count=False) is None
    jobs = {}
    for size in (2, 30, 64):
        want, after = [], None
        while True:
            page = store.page(rule="r", limit=size, after=after).collect()
            want += [r["alert_id"] for r in page]
            if len(page) < size:
                break
            after = page[-1]["alert_created_at"], page[-1]["alert_id"]
        spark.sparkContext.setJobGroup(f"walk-{size}", "")
        got = [(r["page"], r["alert_id"]) for r in store.walk(size, rule="r").collect()]
        jobs[size] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"walk-{size}"))
        spark.sparkContext.setJobGroup("none", "")
        assert sorted(got) == sorted((k // size, i) for k, i in enumerate(want)) and len(got) == 30
    assert len(set(jobs.values())) == 1


def test_the_walk_query_reads_no_page_by_itself(spark, tmp_path, monkeypatch):
    from tidemark.plans import catalog
    from tidemark.service import AlertStore

    monkeypatch.setattr(AlertStore, "page", lambda *a, **k: pytest.fail("a scan of the queue for a page"))
    assert catalog.QUERIES["alert_queue_walk"](spark, "/root/testdata/sf0.001").columns == ["page", "alert_id", "account_id", "last_ts"]


def test_a_micro_batch_of_raw_events_stays_out_of_the_cache(spark, tmp_path):
    """A batch of any size is read from files while it is stored, and these go with it; good messages aren't carried along as text."""
    from tidemark.streaming import bronze

    tables, t = Tables(spark, f"{tmp_path}/tables"), TopicLog(spark, f"{tmp_path}/topics")
    tables.ensure()
    t.ensure(["in", "dead"])
    t.append("in", messages(spark, 6), ["value"])
    real, cache, seen = t.append, spark._jsparkSession.sharedState().cacheManager(), []
    spark.catalog.clearCache()

    def noted(topic, *a, **k):
        seen.append((topic, cache.isEmpty()))
        return real(topic, *a, **k)

    t.append = noted
    bronze.run_bronze(tables, t, ["in"], f"{tmp_path}/ck", "dead")
    assert seen == [("dead", True)] and t.read("dead").count() == 6
    assert tables.files.names(f"{tables.path('bronze_change_events')}__parsed") == []
