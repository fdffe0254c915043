"""Named queries over the test tables and the DuckDB SQL that gives the same rows.

The tables have no bank in them, so users or customers stand for accounts, events or orders for transactions, the event
type for the country, and signup / error / other events for creates, deletes and updates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import checks, identity
from tidemark.operators import fold, quality, rules

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with its time as an instant."""
    e = table(spark, sf_dir, "events")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def text_ts(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def shown(alerts: DataFrame) -> DataFrame:
    """Alerts with arrays and times as text, which hash alike everywhere."""
    return alerts.select("rule", F.col("account_id").cast("long").alias("account_id"), F.array_join("evidence_keys", ",").alias("evidence"), text_ts("first_evidence_ts").alias("first_ts"), text_ts("last_source_commit_ts").alias("last_ts"))


def _burst_sql(base: str, k: int, w: int, rule: str) -> str:
    """base: account, item, ts. The definition said with joins: an event is full if k events lie within w seconds from it on,
    and begins a burst if no full one lies within the w seconds before."""
    return f"""
WITH e AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM ({base})),
full_ones AS (SELECT a.account, a.s FROM e a JOIN e b ON a.account = b.account AND b.s - a.s >= 0 AND b.s - a.s <= {w} GROUP BY a.account, a.s, a.item HAVING count(*) >= {k}),
begins AS (SELECT DISTINCT account, s FROM full_ones f WHERE NOT EXISTS (SELECT 1 FROM full_ones x WHERE x.account = f.account AND x.s < f.s AND x.s >= f.s - {w}))
SELECT '{rule}' AS rule, CAST(g.account AS BIGINT) AS account_id, array_to_string(list_sort(list(CAST(e.item AS VARCHAR))), ',') AS evidence,
  strftime(min(e.ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(e.ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM begins g, e WHERE e.account = g.account AND e.s - g.s >= 0 AND e.s - g.s <= {w} GROUP BY g.account, g.s"""


VELOCITY_SQL = _burst_sql("SELECT user_id AS account, event_id AS item, ts FROM events", 3, 21600, "card_velocity")
TRAVEL_SQL = """
SELECT 'impossible_travel' AS rule, a.user_id AS account_id, a.event_id || ',' || b.event_id AS evidence,
  strftime(a.ts, '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(greatest(a.ts, b.ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) a
JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) b ON a.user_id = b.user_id AND b.k = a.k + 1
WHERE a.event_type <> b.event_type AND floor(epoch(b.ts)) - floor(epoch(a.ts)) <= 3600"""
STRUCTURING_SQL = _burst_sql("SELECT c.c_custkey AS account, o.o_orderkey AS item, o.o_orderdate AS ts FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_totalprice >= 400000 AND o.o_totalprice < 500000", 3, 730 * 86400, "structuring")


def _velocity(spark, sf_dir):
    return rules.bursts(events(spark, sf_dir), "user_id", "event_id", "ts", 3, 21600, "card_velocity")


def _travel(spark, sf_dir):
    return rules.changes_of(events(spark, sf_dir), "user_id", "event_id", "ts", "event_type", 3600, "impossible_travel")


def _structuring(spark, sf_dir):
    o = rules.in_band(table(spark, sf_dir, "orders"), "o_totalprice", 400000, 500000)
    owned = o.join(table(spark, sf_dir, "customer").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    return rules.bursts(owned, "c_custkey", "o_orderkey", "o_orderdate", 3, 730 * 86400, "structuring")


@query(VELOCITY_SQL)
def card_velocity_burst(spark, sf_dir):
    return shown(_velocity(spark, sf_dir))


@query(TRAVEL_SQL)
def impossible_travel(spark, sf_dir):
    return shown(_travel(spark, sf_dir))


@query(STRUCTURING_SQL)
def structuring_band(spark, sf_dir):
    return shown(_structuring(spark, sf_dir))


@query(f"""
WITH a AS (SELECT * FROM ({VELOCITY_SQL}) UNION ALL SELECT * FROM ({TRAVEL_SQL}) UNION ALL SELECT * FROM ({STRUCTURING_SQL}))
SELECT sha256(rule || '|' || CAST(account_id AS VARCHAR) || '|' || split_part(evidence, ',', 1)) AS alert_id, * FROM a""")
def rule_union_alert_id(spark, sf_dir):
    a = rules.as_alerts(rules.union_rules(_velocity(spark, sf_dir), _travel(spark, sf_dir), _structuring(spark, sf_dir)))
    return a.select("alert_id", "rule", F.col("account_id").cast("long").alias("account_id"), F.array_join("evidence_keys", ",").alias("evidence"), text_ts("first_evidence_ts").alias("first_ts"), text_ts("last_source_commit_ts").alias("last_ts"))


@query(f"""
SELECT rule, account_id, evidence, round(epoch(TIMESTAMP '2025-01-01 00:00:00') - epoch(CAST(last_ts AS TIMESTAMP)), 3) AS latency_seconds
FROM ({VELOCITY_SQL})""")
def alert_latency(spark, sf_dir):
    a = rules.as_alerts(_velocity(spark, sf_dir).withColumn("last_source_commit_ts", F.date_trunc("second", "last_source_commit_ts")), F.lit("2025-01-01 00:00:00").cast("timestamp"))
    return a.select("rule", F.col("account_id").cast("long").alias("account_id"), F.array_join("evidence_keys", ",").alias("evidence"), F.round("latency_seconds", 3).alias("latency_seconds"))


def _changes(spark, sf_dir):
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return events(spark, sf_dir).select("user_id", "event_id", op.alias("op"), "ts", "value", "event_type", "props")


def _messages(changes: DataFrame, keys: list[str], after) -> DataFrame:
    """Messages of a topic, of changes with columns op, seq, ts; deletes keep their image too."""
    from tidemark.sources.base import event_json, to_events
    from tidemark.streaming.topic_log import message

    null = F.lit(None).cast("string")
    gone = F.col("op") == "d"
    ev = to_events(changes, "shop", "db", "events", keys, identity.row_json(changes.schema, keys), F.col("op"), F.when(gone, after), after, F.col("seq"), F.date_format("ts", identity.ISO_MICROS), null, "trace")
    rows = ev.select(*message(event_json(), F.col("topic_key"), {"event_id": F.col("event_id")}))
    return rows.select("*", F.lit("events").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"), F.current_timestamp().alias("timestamp"))


FOLD_SQL = """
WITH e AS (SELECT *, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op FROM events)
SELECT user_id, arg_max(value, event_id) FILTER (WHERE op <> 'd') AS value, arg_max(event_type, event_id) FILTER (WHERE op <> 'd') AS kind,
  max(event_id) AS _event_id, arg_max(op, event_id) AS _op, arg_max(op, event_id) = 'd' AS _is_deleted,
  strftime(min(ts) FILTER (WHERE op = 'c'), '%Y-%m-%d %H:%M:%S') AS _first_commit_ts, strftime(arg_max(ts, event_id), '%Y-%m-%d %H:%M:%S') AS _last_commit_ts
FROM e GROUP BY user_id"""


def _state(changes):
    img = F.when(F.col("op") != "d", F.struct("value", F.col("event_type").alias("kind")))
    return fold.state_of(changes, ["user_id"], img, seq="event_id", commit="ts")


def _shown_state(s):
    return s.select("user_id", F.col("body.image.value").alias("value"), F.col("body.image.kind").alias("kind"), F.col("head.event_id").alias("_event_id"), F.col("head.op").alias("_op"), (F.col("head.op") == "d").alias("_is_deleted"), text_ts("first_commit").alias("_first_commit_ts"), text_ts("head.commit_ts").alias("_last_commit_ts"))


@query(FOLD_SQL)
def silver_max_by_fold(spark, sf_dir):
    return _shown_state(fold.fold(_state(_changes(spark, sf_dir)), ["user_id"]))


@query(FOLD_SQL)
def silver_late_batches(spark, sf_dir):
    """The same log folded in three batches out of order, one of them twice."""
    c = _changes(spark, sf_dir)
    state = None
    for k in (2, 0, 1, 0):
        state = fold.merge(state, _state(c.where(F.pmod(F.col("event_id"), F.lit(3)) == k)), ["user_id"])
    return _shown_state(state)


@query("""
WITH e AS (SELECT *, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op FROM events),
f AS (SELECT user_id, event_id, op, last_value(CASE WHEN op <> 'd' THEN {'v': value, 'k': event_type} END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS img,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM e)
SELECT user_id, event_id, op, img.v AS value, img.k AS event_type FROM f WHERE r = 1""")
def silver_latest_state(spark, sf_dir):
    h = fold.history(_changes(spark, sf_dir).drop("props"), ["user_id"], ["event_id"], ["value", "event_type"])
    return fold.latest(h, ["user_id"], ["event_id"]).select("user_id", "event_id", "op", "value", "event_type")


SNAPSHOTS_SQL = """
old AS (SELECT o_orderkey AS k, sha256(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus) AS fp FROM orders WHERE o_orderkey % 7 <> 0),
cur AS (SELECT o_orderkey AS k, sha256(CAST(o_orderkey AS VARCHAR) || '|' || CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END) AS fp FROM orders WHERE o_orderkey % 11 <> 0)"""


@query(f"""
WITH {SNAPSHOTS_SQL}
SELECT coalesce(cur.k, old.k) AS o_orderkey, CASE WHEN old.k IS NULL THEN 'c' WHEN cur.k IS NULL THEN 'd' ELSE 'u' END AS op, substr(coalesce(cur.fp, old.fp), 1, 16) AS fingerprint
FROM cur FULL JOIN old ON cur.k = old.k WHERE cur.fp IS DISTINCT FROM old.fp""")
def snapshot_diff(spark, sf_dir):
    from tidemark.sources.row_versions import snapshot_changes

    o = table(spark, sf_dir, "orders")
    fp = lambda status: identity.fingerprint(F.concat_ws("|", F.col("o_orderkey").cast("string"), status))
    known = o.where("o_orderkey % 7 <> 0").select("o_orderkey", fp(F.col("o_orderstatus")).alias("fingerprint"))
    now = o.where("o_orderkey % 11 <> 0").select("o_orderkey", fp(F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus"))).alias("fingerprint"))
    return snapshot_changes(now, known, ["o_orderkey"]).select("o_orderkey", "op", "fingerprint")


@query("""
WITH old AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 997 <> 0),
cur AS (SELECT o_orderkey, CASE WHEN o_orderkey % 499 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 1009 <> 0)
SELECT coalesce(cur.o_orderkey, old.o_orderkey) AS o_orderkey, CASE WHEN old.o_orderkey IS NULL THEN 'c' WHEN cur.o_orderkey IS NULL THEN 'd' ELSE 'u' END AS op
FROM cur FULL JOIN old ON cur.o_orderkey = old.o_orderkey WHERE cur.o_totalprice IS DISTINCT FROM old.o_totalprice""")
def snapshot_ranges(spark, sf_dir):
    """Two versions of a table that differ in few rows: only rows in ranges of the key whose digests differ are joined."""
    from tidemark.sources.range_digests import Ranges
    from tidemark.sources.row_versions import snapshot_changes

    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    version = lambda df: df.select("o_orderkey", identity.fingerprint(F.col("o_totalprice").cast("string")).alias("fingerprint"))
    known = version(rows.where("o_orderkey % 997 <> 0"))
    now = version(rows.where("o_orderkey % 1009 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 499 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))))
    differ = Ranges(now, known, ["o_orderkey"])
    return snapshot_changes(differ.of(now), differ.of(known), ["o_orderkey"]).select("o_orderkey", "op")


@query("""
SELECT event_id, sha256('shop|events|{"event_id":' || event_id || '}|' || strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS change_id,
  sha256('[null,{"event_id":' || event_id || ',"user_id":' || user_id || '}]') AS payload_hash FROM events""")
def event_id_hash(spark, sf_dir):
    e = events(spark, sf_dir)
    key = identity.row_json(e.schema, ["event_id"])
    after = identity.row_json(e.schema, ["user_id", "event_id"])
    pos = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return e.select("event_id", identity.event_id(F.lit("shop"), F.lit("events"), key, pos).alias("change_id"), identity.payload_hash(F.lit(None).cast("string"), after).alias("payload_hash"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS source_position, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, 'events' AS source_table,
  '{"event_id":' || event_id || '}' AS key_json, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, strftime(ts, '%Y-%m-%d %H:%M:%S') AS commit_ts FROM events""")
def json_envelope_parse(spark, sf_dir):
    """Change events as messages, read back into Bronze columns."""
    from tidemark.streaming.bronze import parsed

    got = parsed(_messages(_changes(spark, sf_dir).withColumn("seq", F.col("event_id").cast("string")), ["event_id"], F.to_json(F.struct("props"))))
    k = F.from_json(F.get_json_object("after_json", "$.props"), "k BIGINT")["k"]
    return got.select("source_position", "op", "source_table", "key_json", k.alias("k"), text_ts("source_commit_ts").alias("commit_ts"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY ALL ORDER BY ALL")
def event_ops_audit(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users")).orderBy("event_type")


@query("SELECT round(quantile_cont(value, 0.5), 2) AS p50, round(quantile_cont(value, 0.95), 2) AS p95, round(max(value), 2) AS max FROM events")
def latency_percentiles(spark, sf_dir):
    return quality.percentiles(table(spark, sf_dir, "events"), "value")


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n, round(quantile_cont(l_extendedprice, 0.01), 3) AS p1, round(quantile_cont(l_extendedprice, 0.5), 3) AS p50,
  round(quantile_cont(l_extendedprice, 0.95), 3) AS p95, round(quantile_cont(l_extendedprice, 0.999), 3) AS p999 FROM lineitem GROUP BY ALL""")
def percentiles_by_group(spark, sf_dir):
    """Exact percentiles of each group by selection of ranks."""
    from tidemark.operators import selection

    found = selection.percentiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", (0.01, 0.5, 0.95, 0.999), ["l_returnflag", "l_linestatus"])
    return found.select("l_returnflag", "l_linestatus", "n", *[F.round(F.get("values", F.lit(i)), 3).alias(p) for i, p in enumerate(("p1", "p50", "p95", "p999"))])


@query("SELECT count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS VARCHAR) AS balance_sum FROM customer")
def balance_sum_exact(spark, sf_dir):
    """A source's own statistics: rows, and the sum of balances to the cent."""
    from tidemark.sources.change_log import ChangeLogSource, LogTable

    rows = table(spark, sf_dir, "customer").withColumn("balance", F.col("c_acctbal").cast("decimal(18,2)"))
    source = ChangeLogSource("s", "db", [LogTable("dbo", "accounts", ["c_custkey"])], None, None, None, lambda t: rows)
    stats = source.stats()["dbo.accounts"]
    return spark.createDataFrame([(stats["rows"], stats["balance_sum"])], "n LONG, balance_sum STRING")


@query("SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-20'")
def watermark_scan(spark, sf_dir):
    """Rows from a watermark on, up to the safety lag; the column as stored, so that the range reaches the scan."""
    from tidemark.sources.row_versions import after_watermark

    day = lambda d: F.lit(d).cast("timestamp_ntz")
    return after_watermark(table(spark, sf_dir, "events"), "ts", day("2024-01-15"), day("2024-01-20"), ["event_id"], None).select("event_id", "user_id", "event_type")


@query("""
WITH b AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-20'),
top AS (SELECT max(ts) AS ts FROM events WHERE ts < TIMESTAMP '2024-01-15'),
known AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-12')
SELECT event_id, CASE WHEN k.user_id IS NULL THEN 'c' ELSE 'u' END AS op
FROM (SELECT * FROM events WHERE ts >= (SELECT ts FROM top) AND ts < TIMESTAMP '2024-01-20') e LEFT JOIN known k ON e.user_id = k.user_id
WHERE NOT (e.ts = (SELECT ts FROM top) AND e.event_id IN (SELECT event_id FROM events WHERE ts = (SELECT ts FROM top)))""")
def keys_at_ts_boundary(spark, sf_dir):
    """A scan from a watermark on (inclusive), without the keys already given at it."""
    from tidemark.sources.row_versions import after_watermark

    e = table(spark, sf_dir, "events")
    cut, end = F.lit("2024-01-15").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz")
    at = e.where(F.col("ts") < cut).agg(F.max("ts")).scalar()
    given = e.where(F.col("ts") == at).select("event_id")
    known = e.where(F.col("ts") < F.lit("2024-01-12").cast("timestamp_ntz")).select("user_id").distinct()
    rows = after_watermark(e, "ts", at, end, ["event_id"], given)
    return rows.join(known.withColumn("seen", F.lit(True)), "user_id", "left").select("event_id", F.when(F.col("seen"), "u").otherwise("c").alias("op"))


@query("""
SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'd' ELSE 'c' END AS op, count(*) AS n FROM lineitem GROUP BY 1""")
def log_operation_codes(spark, sf_dir):
    """Log operation codes (1 delete, 2 insert) read as event ops."""
    from tidemark.sources.change_log import op_of

    code = F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(2)
    return table(spark, sf_dir, "lineitem").select(op_of(code).alias("op")).groupBy("op").agg(F.count("*").alias("n"))


def _update_pairs(o: DataFrame) -> DataFrame:
    from tidemark.sources.change_log import paired

    rows = o.select(F.col("o_custkey").cast("string").alias("lsn"), F.col("o_orderkey").cast("string").alias("seq"), F.explode(F.array(F.lit(3), F.lit(4))).alias("code"), "o_totalprice")
    rows = rows.withColumn("image", F.struct((F.col("o_totalprice") + F.when(F.col("code") == 4, 1.0).otherwise(0.0)).alias("price")))
    p = paired(rows, "lsn", "seq", "code", "image")
    return p.select(F.concat_ws(":", "lsn", "seq").alias("position"), F.col("before.price").alias("before_price"), F.col("after.price").alias("after_price"), "op")


@query("""
SELECT o_custkey || ':' || o_orderkey AS position, CAST(o_totalprice AS DOUBLE) AS before_price, CAST(o_totalprice AS DOUBLE) + 1 AS after_price, 'u' AS op FROM orders""")
def log_update_pairs(spark, sf_dir):
    """Update-before and update-after rows of a change log joined into one change."""
    return _update_pairs(table(spark, sf_dir, "orders"))


@query("""
SELECT event_id, count(*) AS copies FROM (SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE event_id % 3 = 0) GROUP BY event_id HAVING count(*) > 1""")
def bronze_replay_duplicates(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id")
    return e.unionByName(e.where("event_id % 3 = 0")).groupBy("event_id").agg(F.count("*").alias("copies")).where("copies > 1")


@query("SELECT event_id, user_id, event_type FROM events")
def bronze_insert_new(spark, sf_dir):
    """Insert-only merge: a batch with repeats and rows that are there already adds only what is new."""
    from tidemark.streaming.bronze import new_rows

    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    have = e.where("event_id % 2 = 0")
    batch = e.unionByName(e.where("event_id % 3 = 0"))
    return have.unionByName(new_rows(batch, have))


@query("SELECT count(*) AS missing FROM events a ANTI JOIN (SELECT event_id FROM events WHERE event_id % 10 <> 0) b ON a.event_id = b.event_id")
def audit_anti_join(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return quality.missing_events(e, e.where("event_id % 10 <> 0")).agg(F.count("*").alias("missing"))


@query("SELECT event_id, CAST(user_id % 3 AS INT) AS part, row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS offs FROM events")
def topic_partition_offset(spark, sf_dir):
    """Partition by key and gapless offsets, without sorting a partition in one task."""
    from tidemark.streaming.topic_log import with_offsets

    e = table(spark, sf_dir, "events").select("event_id", F.pmod("user_id", F.lit(3)).cast("int").alias("part"))
    return with_offsets(e, "part", ["event_id"], "offs", {}).select("event_id", "part", "offs")


PAGE_SQL = f"""
SELECT sha256(rule || '|' || account_id || '|' || split_part(evidence, ',', 1)) AS alert_id, account_id, last_ts FROM ({VELOCITY_SQL}) ORDER BY last_ts DESC, alert_id"""


def _queue(spark, sf_dir):
    """A store of alerts that were made when their last event was."""
    from tidemark.service import AlertStore
    from tidemark.tables import Tables
    from tidemark.types import QUEUE, schema

    a = rules.as_alerts(_velocity(spark, sf_dir))
    a = a.withColumn("alert_created_at", text_ts("last_source_commit_ts"))
    cols = [f for f in schema(QUEUE) if f.name in a.columns]
    tables = Tables(spark, f"{_scratch(spark)}/tables")
    tables.ensure()
    store = AlertStore(tables)
    store.upsert(a.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in cols]), count=False)
    return store


@query(f"{PAGE_SQL} LIMIT 10 OFFSET 20")
def alert_queue_page(spark, sf_dir):
    """The third page of ten."""
    page = _queue(spark, sf_dir).page(status="OPEN", rule="card_velocity", limit=10, offset=20)
    return page.select("alert_id", F.col("account_id").cast("long").alias("account_id"), F.col("alert_created_at").alias("last_ts"))


@query(f"SELECT CAST((row_number() OVER (ORDER BY last_ts DESC, alert_id) - 1) // 1000 AS INT) AS page, alert_id, account_id, last_ts FROM ({PAGE_SQL})")
def alert_queue_walk(spark, sf_dir):
    """All alerts by pages of a thousand, each of which goes on behind the last row of the one before."""
    walked = _queue(spark, sf_dir).walk(1000, rule="card_velocity")
    return walked.select("page", "alert_id", F.col("account_id").cast("long").alias("account_id"), F.col("alert_created_at").alias("last_ts"))


@query(f"SELECT alert_id, 'CONFIRMED' AS status, 'seen' AS note, true AS decided FROM ({PAGE_SQL} LIMIT 2)")
def analyst_decisions(spark, sf_dir):
    """The first three alerts are decided, one of them is opened again; those that stay decided."""
    store = _queue(spark, sf_dir)
    first = [r["alert_id"] for r in store.list(limit=3)]
    for k in first:
        store.set_status(k, "CONFIRMED", "seen")
    store.set_status(first[2], "OPEN")
    done = store.page(status="CONFIRMED")
    return done.select("alert_id", "status", "note", F.col("decided_at").isNotNull().alias("decided"))


@query(f"SELECT rule, count(*) AS n, count(DISTINCT account_id) AS accounts FROM (SELECT * FROM ({VELOCITY_SQL}) UNION ALL SELECT * FROM ({TRAVEL_SQL})) GROUP BY rule")
def alert_stats(spark, sf_dir):
    return rules.union_rules(_velocity(spark, sf_dir), _travel(spark, sf_dir)).groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("account_id").alias("accounts"))


@query(f"""
WITH a AS (SELECT sha256(rule || '|' || account_id || '|' || split_part(evidence, ',', 1)) AS alert_id, account_id FROM ({VELOCITY_SQL}))
SELECT alert_id, account_id FROM a WHERE account_id % 2 = 1""")
def outbox_pending(spark, sf_dir):
    """Alerts not yet published: those stamped for even accounts are out."""
    from tidemark.operators.outbox import pending, stamped

    a = rules.as_alerts(_velocity(spark, sf_dir))
    sent = a.where("account_id % 2 = 0").select("alert_id")
    return pending(stamped(a, sent, F.lit("2025-01-01").cast("timestamp"))).select("alert_id", F.col("account_id").cast("long").alias("account_id"))


@query(f"""
WITH a AS (SELECT row_number() OVER () AS id, rule, evidence FROM ({VELOCITY_SQL})),
ax AS (SELECT id, rule, unnest(string_split(evidence, ',')) AS k FROM a),
t AS (SELECT 'card_velocity' AS rule, user_id, event_id AS k FROM events WHERE user_id % 4 = 0 AND event_type = 'purchase'),
h AS (SELECT DISTINCT id FROM ax JOIN (SELECT DISTINCT CAST(k AS VARCHAR) AS k FROM t) USING (k)),
c AS (SELECT DISTINCT user_id FROM t JOIN (SELECT DISTINCT k FROM ax) x ON CAST(t.k AS VARCHAR) = x.k)
SELECT 'card_velocity' AS rule, (SELECT count(*) FROM a) AS alerts, (SELECT count(*) FROM h) AS true_positives, (SELECT count(*) FROM a) - (SELECT count(*) FROM h) AS false_positives,
  (SELECT count(DISTINCT user_id) FROM t) AS planted, (SELECT count(*) FROM c) AS caught,
  round((SELECT count(*) FROM h) / (SELECT count(*) FROM a)::DOUBLE, 3) AS precision, round((SELECT count(*) FROM c) / (SELECT count(DISTINCT user_id) FROM t)::DOUBLE, 3) AS recall""")
def score_recall(spark, sf_dir):
    truth = table(spark, sf_dir, "events").where("user_id % 4 = 0 and event_type = 'purchase'").groupBy("user_id").agg(F.collect_list("event_id").alias("keys")).select(F.lit("card_velocity").alias("rule"), "keys")
    return quality.scores(_velocity(spark, sf_dir), truth)


def _lineage(spark, sf_dir, a: DataFrame) -> DataFrame:
    e = events(spark, sf_dir)
    null = F.lit(None).cast("string")
    bronze = e.select(F.col("event_id").cast("string").alias("event_id"), F.col("event_type").alias("op"), F.lit("shop").alias("source_system"), F.lit("events").alias("source_table"), null.alias("source_position"), null.alias("source_sequence"), F.col("ts").alias("source_commit_ts"), null.alias("kafka_topic"), null.alias("kafka_partition"), null.alias("kafka_offset"), identity.row_json(e.schema, ["event_id"]).alias("key_json"), null.alias("after_json"))
    return quality.lineage(a, bronze, {"card_velocity": ("events", "event_id")}).select("alert_id", "entity_key", "op")


@query(f"""
WITH a AS (SELECT sha256(rule || '|' || account_id || '|' || split_part(evidence, ',', 1)) AS alert_id, unnest(string_split(evidence, ',')) AS k FROM ({VELOCITY_SQL}))
SELECT alert_id, CAST(e.event_id AS VARCHAR) AS entity_key, e.event_type AS op FROM a JOIN events e ON CAST(e.event_id AS VARCHAR) = a.k""")
def lineage_explode(spark, sf_dir):
    """The evidence of every alert and the events behind it."""
    return _lineage(spark, sf_dir, rules.as_alerts(_velocity(spark, sf_dir)))


@query(f"""
WITH a AS (SELECT sha256(rule || '|' || account_id || '|' || split_part(evidence, ',', 1)) AS alert_id, unnest(string_split(evidence, ',')) AS k FROM ({VELOCITY_SQL}))
SELECT alert_id, CAST(e.event_id AS VARCHAR) AS entity_key, e.event_type AS op FROM a JOIN events e ON CAST(e.event_id AS VARCHAR) = a.k""")
def lineage_by_postings(spark, sf_dir):
    """The same from raw events in twelve batches, of which those are read that the postings of their keys name; eight are merged, one has none."""
    from tidemark.streaming.postings import Postings
    from tidemark.tables import Tables

    tables = Tables(spark, f"{_scratch(spark)}/tables")
    tables.ensure()
    sources = {"card_velocity": ("events", "event_id")}
    postings = Postings(tables, set(sources.values()))
    e = events(spark, sf_dir)
    raw = e.select(F.col("event_id").cast("string").alias("event_id"), F.col("event_type").alias("op"), F.lit("events").alias("source_table"), identity.row_json(e.schema, ["event_id"]).alias("key_json"), (F.col("event_id") % 12).alias("b"))
    for b in range(12):
        tables.append("bronze_change_events", raw.where(F.col("b") == b), batch=b)
        if b < 11:
            postings.add(b)
        if b == 7:
            postings.merge()
    return postings.lineage(rules.as_alerts(_velocity(spark, sf_dir)), sources).select("alert_id", "entity_key", "op")


@query("""
SELECT s_suppkey, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS amount FROM supplier WHERE s_acctbal > 0 AND s_acctbal < 2000""")
def amount_band_decimal(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").withColumn("amount", checks.amount(F.format_string("%.2f", "s_acctbal")))
    return rules.in_band(s, "amount", 0.01, 2000).select("s_suppkey", F.col("amount").cast("string").alias("amount"))


@query("""
WITH c AS (SELECT c_nationkey, count(*) AS s, count(*) FILTER (WHERE c_custkey % 100 <> 0) AS t FROM customer GROUP BY 1)
SELECT CASE WHEN n_regionkey = 0 THEN 'SKIP' WHEN coalesce(s, 0) = coalesce(t, 0) THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS n
FROM nation LEFT JOIN c ON n_nationkey = c_nationkey GROUP BY 1""")
def reconcile_counts(spark, sf_dir):
    """Source and target counts per nation; one region's snapshot is pending."""
    n, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    counts = c.groupBy("c_nationkey").agg(F.count("*").alias("source"), F.count_if(F.col("c_custkey") % 100 != 0).alias("target"))
    j = n.join(counts, n["n_nationkey"] == counts["c_nationkey"], "left").na.fill(0, ["source", "target"])
    return j.select(quality.verdict(F.col("source"), F.col("target"), F.col("n_regionkey") == 0).alias("status")).groupBy("status").agg(F.count("*").alias("n"))


@query("""
WITH g AS (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 21, '0') AS bban FROM customer),
d AS (SELECT *, 98 - CAST(CAST(bban || '252900' AS HUGEINT) % 97 AS INT) AS good FROM g),
w AS (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN good % 97 + 1 + CASE WHEN good % 97 + 1 = good THEN 1 ELSE 0 END ELSE good END AS digits FROM d)
SELECT c_custkey, CAST(bban || '2529' || lpad(CAST(digits AS VARCHAR), 2, '0') AS HUGEINT) % 97 = 1 AS valid FROM w""")
def iban_mod97(spark, sf_dir):
    """Made-up Portuguese account numbers with right check digits, every third one spoilt."""
    bban = F.lpad(F.col("c_custkey").cast("string"), 21, "0")
    rest = F.expr("cast(concat(lpad(cast(c_custkey as string), 21, '0'), '252900') as decimal(38,0)) % 97").cast("int")
    check = F.lpad((98 - rest).cast("string"), 2, "0")
    wrong = F.lpad(((98 - rest) % 97 + 1 + F.when((98 - rest) % 97 + 1 == 98 - rest, 1).otherwise(0)).cast("string"), 2, "0")
    iban = F.concat(F.lit("PT"), F.when(F.col("c_custkey") % 3 == 0, wrong).otherwise(check), bban)
    return table(spark, sf_dir, "customer").select("c_custkey", checks.iban_valid(iban).alias("valid"))


TRANSFERS_SQL = """
t AS (SELECT CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS transfer_id, 'PT00' AS debtor_iban, 'PT00' AS creditor_iban,
  CASE WHEN o_orderkey % 4 = 1 THEN '1.250,00' ELSE '12.50' END AS amount, CAST(o_orderdate AS VARCHAR) AS booking_ts FROM orders),
judged AS (SELECT CASE WHEN coalesce(transfer_id, '') = '' THEN 'missing transfer_id' WHEN coalesce(debtor_iban, '') = '' THEN 'missing debtor_iban'
  WHEN coalesce(creditor_iban, '') = '' THEN 'missing creditor_iban' WHEN coalesce(amount, '') = '' THEN 'missing amount' WHEN coalesce(booking_ts, '') = '' THEN 'missing booking_ts'
  WHEN try_cast(amount AS DECIMAL(38,18)) IS NULL OR try_cast(amount AS DECIMAL(38,18)) <= 0 THEN 'invalid amount'
  WHEN length(debtor_iban) < 15 THEN 'invalid debtor_iban' WHEN length(creditor_iban) < 15 THEN 'invalid creditor_iban' END AS fault FROM t)"""


@query(f"WITH {TRANSFERS_SQL} SELECT fault, count(*) AS n FROM judged GROUP BY fault")
def dlq_rejects(spark, sf_dir):
    """Why each made-up transfer is refused: the first reason in order."""
    return _spoilt_transfers(spark, sf_dir).select(checks.transfer_fault().alias("fault")).groupBy("fault").agg(F.count("*").alias("n"))


def _spoilt_transfers(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey").cast("string")).alias("transfer_id"),
        F.lit("PT00").alias("debtor_iban"),
        F.lit("PT00").alias("creditor_iban"),
        F.when(F.col("o_orderkey") % 4 == 1, "1.250,00").otherwise("12.50").alias("amount"),
        F.col("o_orderdate").cast("string").alias("booking_ts"),
    )


@query("""
WITH e AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'x' ELSE 'c' END AS op, CASE WHEN event_id % 5 <> 1 THEN '{}' END AS after FROM events),
f AS (SELECT event_id, [CASE WHEN op NOT IN ('c', 'u', 'd', 'r') THEN 'unknown op' END, CASE WHEN op = 'c' AND after IS NULL THEN 'a create needs an after image' END] AS all_ FROM e)
SELECT event_id, array_to_string(list_filter(all_, lambda x: x IS NOT NULL), '; ') AS faults FROM f""")
def envelope_violations(spark, sf_dir):
    """Change events with planted faults, parsed from their JSON and checked."""
    from tidemark.types import EVENT

    e = table(spark, sf_dir, "events")
    after = F.when(F.col("event_id") % 5 != 1, F.struct("user_id"))
    src = F.struct(F.lit("shop").alias("system"), F.lit("db").alias("database"), F.lit("events").alias("table"), F.col("event_id").cast("string").alias("position"))
    wire = F.to_json(F.struct(F.sha2(F.col("event_id").cast("string"), 256).alias("event_id"), F.when(F.col("event_id") % 5 == 0, "x").otherwise("c").alias("op"), F.struct("event_id").alias("key"), after.alias("after"), src.alias("source"), F.lit("2024-01-01T00:00:00").alias("captured_at"), F.lit("t").alias("trace_id"), F.lit(1).alias("schema_version"), F.sha2(F.lit("p"), 256).alias("payload_hash")))
    parsed = e.select("event_id", F.from_json(wire, EVENT).alias("e"))
    return parsed.select("event_id", F.array_join(checks.event_faults("e"), "; ").alias("faults"))


@query("SELECT nation.n_nationkey, nation.n_name, region.r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def file_csv_scan(spark, sf_dir):
    """CSV text to rows with line numbers (here from joined tables written as lines), each line parsed by its header."""
    from tidemark.sources.file_drop import csv_rows

    j = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    text = F.concat(F.lit("n_nationkey,n_name,r_name\n"), F.col("n_nationkey").cast("string"), F.lit(",\""), F.col("n_name"), F.lit("\","), F.col("r_name"), F.lit("\n"))
    files = j.select(F.concat(F.lit("f"), F.col("n_nationkey").cast("string")).alias("name"), text.alias("content"))
    rows = csv_rows(files, "content", ["n_nationkey", "n_name", "r_name"])
    return rows.select(F.col("row.n_nationkey").cast("int").alias("n_nationkey"), "row.n_name", "row.r_name")


def _scratch(spark: SparkSession) -> str:
    """A folder for the tables and topics of one run, below spark.checkpoint.dir."""
    import uuid

    from tidemark.streaming.topic_log import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return f"{spark.conf.get('spark.checkpoint.dir', None) or spark.sparkContext._jsc.sc().getCheckpointDir().get()}/run-{uuid.uuid4().hex}"


STREAM_SQL = """
WITH e AS (SELECT *, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op FROM events)
SELECT user_id, arg_max(value, event_id) FILTER (WHERE op <> 'd') AS value, CAST(max(event_id) AS VARCHAR) AS last_event, arg_max(op, event_id) AS _op, arg_max(op, event_id) = 'd' AS _is_deleted FROM e GROUP BY user_id"""


@query(STREAM_SQL)
def stream_to_latest_state(spark, sf_dir):
    """Events published to a topic, one batch of them twice, streamed into the raw table and folded into the latest state."""
    from tidemark.sources.base import event_json, to_events
    from tidemark.streaming.bronze import run_bronze
    from tidemark.streaming.silver import Entity, run_silver, view
    from tidemark.streaming.topic_log import TopicLog, message
    from tidemark.tables import Tables

    root = _scratch(spark)
    tables, topics = Tables(spark, f"{root}/tables"), TopicLog(spark, f"{root}/topics")
    tables.ensure()
    topics.ensure(["events", "dead"])
    c = _changes(spark, sf_dir).withColumn("seq", F.lpad(F.col("event_id").cast("string"), 12, "0"))
    image = F.to_json(F.struct("user_id", "value", "event_id"), {"ignoreNullFields": "false"})
    null = F.lit(None).cast("string")
    gone = F.col("op") == "d"  # a delete has its key alone, as of a source that is polled
    ev = to_events(c, "db2", "shop", "events", ["user_id"], identity.row_json(c.schema, ["user_id"]), F.col("op"), null, F.when(~gone, image), F.col("seq"), F.date_format("ts", identity.ISO_MICROS), F.col("seq"), "trace")
    rows = ev.select(*message(event_json(), F.col("topic_key"), {"event_id": F.col("event_id")}), F.col("source.sequence").alias("seq"))
    entity = Entity("events", "silver_events", ["user_id"], "user_id BIGINT, value DOUBLE, event_id BIGINT")
    # the later part first, and a part of it again
    for part in ("seq % 2 = 1", "seq % 2 = 0", "seq % 3 = 0"):
        topics.append("events", rows.where(part), ["seq"])
        run_bronze(tables, topics, ["events"], f"{root}/ck/bronze", "dead")
        run_silver(tables, [entity], f"{root}/ck/silver")
    out = view(tables, entity)
    return out.select("user_id", "value", F.col("_source_sequence").cast("bigint").cast("string").alias("last_event"), "_op", "_is_deleted")


@query("""
SELECT 'none' AS case_, o_orderkey FROM orders WHERE false UNION ALL SELECT 'few', o_orderkey FROM orders WHERE o_orderkey % 1000 = 7
UNION ALL SELECT 'most', o_orderkey FROM orders WHERE o_orderkey % 10 <> 0""")
def audit_missing_ids(spark, sf_dir):
    """Ids that were sent and never stored, from sketches of the batches on both sides: none, a few, and more than a sketch can tell, which takes the join."""
    from tidemark.operators import set_sketch
    from tidemark.tables import Tables

    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("event_id"), "o_orderkey")
    out = None
    for case, kept in (("none", "true"), ("few", "o_orderkey % 1000 <> 7"), ("most", "o_orderkey % 10 = 0")):
        tables = Tables(spark, f"{_scratch(spark)}/tables")
        tables.ensure()
        for b in range(3):
            tables.append("cdc_event_audit", o.where(F.col("o_orderkey") % 3 == b), batch=b)
            tables.append("bronze_change_events", o.where((F.col("o_orderkey") / 5000).cast("int") % 3 == b).where(kept), batch=b)
        lost = set_sketch.missing(tables, "cdc_event_audit", "bronze_change_events").select(F.lit(case).alias("case_"), F.col("event_id").cast("long").alias("o_orderkey"))
        out = lost if out is None else out.unionByName(lost)
    return out


@query("SELECT CASE o_orderkey % 2 WHEN 0 THEN 'batch=0' ELSE 'batch=2' END AS batch, o_orderkey FROM orders")
def bronze_batches(spark, sf_dir):
    """Orders published in three parts: the even ones, a part of these again, and all. Each is stored once, with the batch that brought it first; batches are
    compared with those alone whose fingerprints they share."""
    from tidemark.sources.base import event_json, to_events
    from tidemark.streaming.bronze import run_bronze
    from tidemark.streaming.topic_log import TopicLog, message
    from tidemark.tables import Tables

    root = _scratch(spark)
    tables, topics = Tables(spark, f"{root}/tables"), TopicLog(spark, f"{root}/topics")
    tables.ensure()
    topics.ensure(["orders", "dead"])
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").withColumn("seq", F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    image = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    ev = to_events(o, "db2", "shop", "orders", ["o_orderkey"], identity.row_json(o.schema, ["o_orderkey"]), F.lit("c"), F.lit(None).cast("string"), image, F.col("seq"), F.lit("2025-01-01T00:00:00"), F.col("seq"), "trace")
    rows = ev.select(*message(event_json(), F.col("topic_key"), {"event_id": F.col("event_id")}), F.col("source.sequence").alias("seq"))
    for part in ("seq % 2 = 0", "seq % 4 = 0", "true"):
        topics.append("orders", rows.where(part), ["seq"])
        run_bronze(tables, topics, ["orders"], f"{root}/ck/bronze", "dead")
    stored = tables.read("bronze_change_events").select(F.regexp_extract(F.col("_metadata.file_path"), "/(batch=[0-9]+)/", 1).alias("batch"), F.get_json_object("key_json", "$.o_orderkey").cast("long").alias("o_orderkey"))
    return stored


@query("SELECT o_custkey, max(o_orderkey) AS last_order, count(*) AS orders FROM orders GROUP BY o_custkey")
def state_bucket_merge(spark, sf_dir):
    """A state table of customers that the orders are merged into in three batches, its buckets doubling on the way."""
    from tidemark.tables import Tables

    tables = Tables(spark, f"{_scratch(spark)}/tables", buckets=2, bucket_bytes=1 << 12)
    o = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("last_order"), F.lit(1).cast("long").alias("orders"), (F.col("o_orderkey") % 3).alias("part"))

    def add(old, new):
        both = new if old is None else old.unionByName(new)
        return both.groupBy("o_custkey").agg(F.max("last_order").alias("last_order"), F.sum("orders").alias("orders"))

    for part in range(3):
        tables.merge("customers", o.where(F.col("part") == part).drop("part"), ["o_custkey"], add)
    return tables.read("customers")


@query(f"""
WITH a AS (SELECT sha256(rule || '|' || account_id || '|' || split_part(evidence, ',', 1)) AS alert_id, account_id FROM ({VELOCITY_SQL})),
s AS (SELECT *, CASE WHEN account_id % 3 = 0 THEN 'CONFIRMED' ELSE 'OPEN' END AS status FROM a)
SELECT status, count(*) AS n, count(DISTINCT alert_id) AS ids FROM s GROUP BY status""")
def analyst_queue_upsert(spark, sf_dir):
    """A repeated alert refreshes its evidence; what analysts decided stays."""
    a = rules.as_alerts(_velocity(spark, sf_dir)).select("alert_id", "account_id", F.lit("OPEN").alias("status"))
    decided = a.withColumn("status", F.when(F.col("account_id") % 3 == 0, "CONFIRMED").otherwise("OPEN")).where("account_id % 2 = 0 or account_id % 3 = 0")
    return fold.upsert(decided, a, ["alert_id"], ["status"]).groupBy("status").agg(F.count("*").alias("n"), F.count_distinct("alert_id").alias("ids"))


@query("""
SELECT c_custkey, substr(sha256('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_nationkey":' || c_nationkey || '}'), 1, 16) AS fingerprint FROM customer""")
def row_fingerprint(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", identity.fingerprint(identity.row_json(c.schema, ["c_nationkey", "c_mktsegment", "c_custkey"])).alias("fingerprint"))


@query("""
WITH w AS (SELECT 's' || (user_id % 7) AS source_name, event_id, ts FROM events)
SELECT source_name, max(event_id) AS watermark, strftime(arg_max(ts, event_id), '%Y-%m-%d %H:%M:%S') AS updated_at FROM w GROUP BY 1""")
def control_upsert(spark, sf_dir):
    """Watermarks written over and over: one row a source, the last written."""
    e = events(spark, sf_dir).select(F.concat(F.lit("s"), (F.col("user_id") % 7).cast("string")).alias("source_name"), F.col("event_id").alias("watermark"), text_ts("ts").alias("updated_at"))
    state = None
    for part in (e.where("watermark % 2 = 0"), e):
        state = fold.upsert(state, fold.latest(part, ["source_name"], ["watermark"]), ["source_name"])
    return state


def _manifest(o: DataFrame, file_number) -> DataFrame:
    from tidemark.sources.file_drop import csv_rows

    line = F.concat_ws(",", F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, "1.250").otherwise("12.50"))
    files = o.groupBy(F.concat(F.lit("f"), file_number.cast("string")).alias("file_name")).agg(F.concat(F.lit("id,amount\n"), F.array_join(F.collect_list(line), "\n")).alias("content"))
    rows = csv_rows(files, "content", ["id", "amount"])
    good = checks.amount(F.col("row.amount")).isNotNull()
    return rows.groupBy("file_name").agg(F.count_if(good).alias("rows"), F.count_if(~good).alias("rejected"), F.count_distinct(F.when(good, F.col("row.id"))).alias("ids"))


@query("""
SELECT 'f' || (o_orderkey // 1000) AS file_name, count(*) FILTER (WHERE o_orderkey % 3 <> 0) AS "rows", count(*) FILTER (WHERE o_orderkey % 3 = 0) AS rejected, count(DISTINCT o_custkey) FILTER (WHERE o_orderkey % 3 <> 0) AS ids
FROM orders GROUP BY 1""")
def file_manifest_counts(spark, sf_dir):
    """Rows, refused rows and distinct valid ids of files made of the orders, 1,000 keys each, so that no file grows with the table."""
    return _manifest(table(spark, sf_dir, "orders"), F.expr("o_orderkey div 1000"))


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def key_set_difference(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return table(spark, sf_dir, "customer").select("c_custkey").join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").distinct()


LOG_SQL = """
l AS (SELECT event_id, user_id, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
  '0x' || printf('%020x', event_id) || ':0x' || printf('%020x', 1) AS position, '{"event_id":' || event_id || '}' AS key,
  '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS image FROM events)"""


def _event_log(spark, sf_dir):
    """The events as a database's change log, and a source over it whose log ends where it is told to."""
    from tidemark.sources.change_log import ChangeLogSource, LogTable

    place = lambda c: F.unhex(F.lpad(F.hex(c), 20, "0"))
    c = _changes(spark, sf_dir)
    code = F.when(F.col("op") == "c", 2).when(F.col("op") == "d", 1).otherwise(4)
    one = c.select(place(F.col("event_id")).alias("lsn"), place(F.lit(1).cast("long")).alias("seq"), code.alias("code"), F.col("ts").alias("commit_ts"), "event_id", "user_id")
    log = one.unionByName(one.where("code = 4").withColumn("code", F.lit(3)))  # an update's row before it is as the one after
    top = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]

    def source(end: int):
        at = lambda n: n.to_bytes(10, "big")
        return ChangeLogSource("shop", "db", [LogTable("dbo", "events", ["event_id"])], lambda t: log, lambda: at(end), lambda t: at(0))

    return source, top


@query(f"WITH {LOG_SQL} SELECT key, op, position, CASE WHEN op <> 'c' THEN image END AS before, CASE WHEN op <> 'd' THEN image END AS after FROM l")
def log_change_scan(spark, sf_dir):
    """A change log read in two runs, the second from the first one's watermark on."""
    source, top = _event_log(spark, sf_dir)
    first = source(top // 2).capture(None, "t")
    second = source(top).capture(first.watermark, "t")
    return first.events.unionByName(second.events).select("key", "op", "source.position", "before", "after")


@query(f"WITH {LOG_SQL} SELECT key, op, position, CASE WHEN op <> 'c' THEN image END AS before, CASE WHEN op <> 'd' THEN image END AS after FROM l")
def log_change_stream(spark, sf_dir):
    """The same as a stream whose offsets are the log's positions: it stops in the middle of the log, and a second one goes on from the checkpoint."""
    from tidemark.sources.change_log import ChangeLogSource, LogTable
    from tidemark.sources.log_stream import log_source, parquet_log

    root = _scratch(spark)
    root = root if "://" in root else f"file://{root}"
    source, top = _event_log(spark, sf_dir)
    log = source(top).read("dbo.events").withColumn("commit_ts", F.date_format("commit_ts", identity.ISO_MICROS))
    t, ddl = LogTable("dbo", "events", ["event_id"]), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in log.schema)
    capture = ChangeLogSource("shop", "db", [t], None, None, None)

    def each(batch: DataFrame, number: int) -> None:
        capture.events_of(batch.withColumn("commit_ts", F.col("commit_ts").cast("timestamp")), t, "trace").write.mode("overwrite").parquet(f"{root}/events/batch={number}")

    middle = F.unhex(F.lpad(F.hex(F.lit(top // 2)), 20, "0"))
    for part in (F.col("lsn") <= middle, F.col("lsn") > middle):  # the log grows between the runs
        log.where(part).write.mode("append").parquet(f"{root}/log")
        spark.dataSource.register(log_source(parquet_log(f"{root}/log", log.columns), ddl))
        spark.readStream.format("change_log").load().writeStream.foreachBatch(each).option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/events").select("key", "op", "source.position", "before", "after")


@query("SELECT r_name, 2 * r_regionkey < 4 AS gap FROM region")
def log_gap_detection(spark, sf_dir):
    """For each last position read (twice the key): whether changes after it are gone, where the log begins at 4."""
    from tidemark.sources.change_log import ChangeLogSource, GapError, LogTable

    at = lambda n: n.to_bytes(10, "big")
    empty = spark.createDataFrame([], "lsn BINARY, seq BINARY, code INT, commit_ts TIMESTAMP, id INT")
    source = ChangeLogSource("s", "db", [LogTable("dbo", "t", ["id"])], lambda t: empty, lambda: at(9), lambda t: at(4))
    out = []
    for r in table(spark, sf_dir, "region").collect():
        try:
            source.capture({"lsn": {"dbo.t": "0x" + at(2 * r["r_regionkey"]).hex()}}, "t")
            out.append((r["r_name"], False))
        except GapError:
            out.append((r["r_name"], True))
    return spark.createDataFrame(out, "r_name STRING, gap BOOLEAN")


@query("SELECT n_nationkey, n_nationkey % 3 = 0 AS due FROM nation")
def snapshot_cadence(spark, sf_dir):
    """Run after run: which take a snapshot, if every third does and the first."""
    from tidemark.sources.row_versions import snapshot_due

    state, out = {}, []
    for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect():
        due, runs = snapshot_due(state, 3)
        state = {"runs_since_snapshot": runs}
        out.append((r["n_nationkey"], due))
    return spark.createDataFrame(out, "n_nationkey INT, due BOOLEAN")


@query(f"WITH {LOG_SQL} SELECT op, count(*) AS n, count(DISTINCT position) AS positions, CAST(count(*) AS BIGINT) AS delivered FROM l GROUP BY op")
def capture_run(spark, sf_dir):
    """Captured, published and audited in two runs, the watermark committed last; each change is delivered once."""
    from tidemark import pipeline
    from tidemark.streaming.topic_log import TopicLog
    from tidemark.tables import Tables

    root = _scratch(spark)
    tables, topics = Tables(spark, f"{root}/tables"), TopicLog(spark, f"{root}/topics")
    tables.ensure()
    topics.ensure(["events", "dead"])
    source, top = _event_log(spark, sf_dir)
    for end in (top // 2, top, top):
        pipeline.run_capture(tables, topics, source(end), {"dbo.events": "events"}, "dead")
    audit = tables.read("cdc_event_audit")
    sent = topics.read("events").select(F.col("partition").alias("p"), F.col("offset").alias("o"), F.lit(1).alias("sent"))
    j = audit.join(sent, (F.col("kafka_partition") == F.col("p")) & (F.col("kafka_offset") == F.col("o")), "left")
    return j.groupBy("op").agg(F.count("*").alias("n"), F.count_distinct("source_position").alias("positions"), F.count("sent").alias("delivered"))


@query(f"WITH {TRANSFERS_SQL} SELECT fault AS reason, count(*) AS n FROM judged WHERE fault IS NOT NULL GROUP BY fault")
def dlq_publish(spark, sf_dir):
    """Refused rows sent to the dead-letter topic and read back."""
    from tidemark import pipeline
    from tidemark.sources.base import REJECT
    from tidemark.streaming.topic_log import TopicLog

    topics = TopicLog(spark, f"{_scratch(spark)}/topics")
    topics.ensure(["dead"])
    bad = _spoilt_transfers(spark, sf_dir).withColumn("reason", checks.transfer_fault()).where("reason is not null")
    pipeline.publish(topics, None, {}, bad.select(F.lit("s").alias("source_system"), "booking_ts", "reason", F.col("amount").alias("raw")).withColumnRenamed("booking_ts", "position"), "dead", "s")
    body = F.from_json("value", REJECT)
    return topics.read("dead").select(body["reason"].alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


GOLD_SQL = f"""
SELECT * FROM ({_burst_sql("SELECT user_id AS account, event_id AS item, ts FROM events", 5, 600, "card_velocity")}) UNION ALL SELECT * FROM ({TRAVEL_SQL})
UNION ALL SELECT * FROM ({_burst_sql("SELECT o_custkey AS account, o_orderkey AS item, o_orderdate AS ts FROM orders WHERE o_totalprice >= 9000 AND o_totalprice < 10000", 3, 86400, "structuring")})"""


@query(f"SELECT sha256(rule || '|' || CAST(account_id AS VARCHAR) || '|' || split_part(evidence, ',', 1)) AS alert_id, rule, account_id, evidence, true AS kept FROM ({GOLD_SQL})")
def gold_run_twice(spark, sf_dir):
    """All rules run over the latest state, twice: the second run changes no alert and keeps when each was made."""
    from tidemark import pipeline
    from tidemark.tables import Tables

    tables = Tables(spark, f"{_scratch(spark)}/tables")
    tables.ensure()
    e, o = events(spark, sf_dir), table(spark, sf_dir, "orders")
    cards = e.select(F.col("event_id").alias("tx_id"), F.col("user_id").alias("account_id"), F.col("event_type").alias("country"), F.col("ts").alias("tx_ts"), F.col("ts").alias("_first_commit_ts"))
    transfers = o.select(F.col("o_orderkey").cast("string").alias("transfer_id"), F.col("o_custkey").cast("string").alias("debtor_iban"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").cast("timestamp").alias("booking_ts"), F.col("o_orderdate").cast("timestamp").alias("_first_commit_ts"), F.lit(False).alias("_is_deleted"))
    accounts = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("iban"), F.col("c_custkey").alias("account_id"))
    pipeline.run_gold(tables, cards, transfers, accounts)
    made = tables.read("gold_fraud_alerts").select("alert_id", F.col("alert_created_at").alias("made"))
    pipeline.run_gold(tables, cards, transfers, accounts)
    now = tables.read("gold_fraud_alerts").join(made, "alert_id", "left")
    return now.select("alert_id", "rule", F.col("account_id").cast("long").alias("account_id"), F.array_join("evidence_keys", ",").alias("evidence"), F.col("alert_created_at").eqNullSafe(F.col("made")).alias("kept"))


@query(f"SELECT rule, account_id, evidence FROM ({GOLD_SQL})")
def gold_by_batch(spark, sf_dir):
    """Alerts made batch by batch, each from what the batch touches: users of either parity, orders before the accounts they belong to."""
    from tidemark import pipeline
    from tidemark.streaming.silver import Entity, run_silver
    from tidemark.tables import Tables

    root = _scratch(spark)
    tables = Tables(spark, f"{root}/tables")
    tables.ensure()
    entities = [
        Entity(pipeline.CARDS, "silver_cards", ["tx_id"], "tx_id BIGINT, account_id INT, country STRING, tx_ts TIMESTAMP"),
        Entity(pipeline.TRANSFERS, "silver_transfers", ["transfer_id"], "transfer_id STRING, debtor_iban STRING, amount DOUBLE, booking_ts TIMESTAMP"),
        Entity(pipeline.ACCOUNTS, "silver_accounts", ["account_id"], "account_id INT, iban STRING"),
    ]

    def created(e: Entity, rows: DataFrame) -> DataFrame:
        key, image = (F.to_json(F.struct(*names)) for names in (e.primary_key, e.names))
        at = F.col("tx_ts") if "tx_ts" in e.names else F.col("booking_ts") if "booking_ts" in e.names else F.current_timestamp()
        return rows.select(F.concat_ws(":", F.lit(e.source_table), key).alias("event_id"), F.lit("c").alias("op"), F.lit(e.source_table).alias("source_table"), F.lit("1").alias("source_sequence"), at.alias("source_commit_ts"), key.alias("key_json"), image.alias("after_json"))

    v, o, c = events(spark, sf_dir), table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    cards = v.select(F.col("event_id").alias("tx_id"), F.col("user_id").alias("account_id"), F.col("event_type").alias("country"), F.col("ts").alias("tx_ts"))
    transfers = o.select(F.col("o_orderkey").cast("string").alias("transfer_id"), F.col("o_custkey").cast("string").alias("debtor_iban"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").cast("timestamp").alias("booking_ts"))
    accounts = c.select(F.col("c_custkey").alias("account_id"), F.col("c_custkey").cast("string").alias("iban"))
    batches = [[created(entities[0], cards.where("account_id % 2 = 0")), created(entities[1], transfers)], [created(entities[0], cards.where("account_id % 2 = 1")), created(entities[2], accounts)]]
    for i, (a, b) in enumerate(batches):
        tables.append("bronze_change_events", a.unionByName(b), batch=i)
        run_silver(tables, entities, f"{root}/ck/silver", pipeline.gold_after(tables, entities))
    return tables.read("gold_fraud_alerts").select("rule", F.col("account_id").cast("long").alias("account_id"), F.array_join("evidence_keys", ",").alias("evidence"))


@query(f"SELECT rule, account_id, evidence FROM ({GOLD_SQL})")
def gold_by_slabs(spark, sf_dir):
    """Alerts made batch by batch from the slabs around what changed: cards that begin with an account each are moved to their users by updates
    without an image before, those of even users first."""
    from tidemark import pipeline
    from tidemark.streaming.silver import Entity, run_silver
    from tidemark.tables import Tables

    root = _scratch(spark)
    tables = Tables(spark, f"{root}/tables")
    tables.ensure()
    entities = [
        Entity(pipeline.CARDS, "silver_cards", ["tx_id"], "tx_id BIGINT, account_id BIGINT, country STRING, tx_ts TIMESTAMP"),
        Entity(pipeline.TRANSFERS, "silver_transfers", ["transfer_id"], "transfer_id STRING, debtor_iban STRING, amount DOUBLE, booking_ts TIMESTAMP"),
        Entity(pipeline.ACCOUNTS, "silver_accounts", ["account_id"], "account_id BIGINT, iban STRING"),
    ]

    def sent(e: Entity, rows: DataFrame, op: str, seq: int) -> DataFrame:
        key, image = (F.to_json(F.struct(*names)) for names in (e.primary_key, e.names))
        at = F.col("tx_ts") if "tx_ts" in e.names else F.col("booking_ts") if "booking_ts" in e.names else F.current_timestamp()
        return rows.select(F.concat_ws(":", F.lit(e.source_table), key, F.lit(seq)).alias("event_id"), F.lit(op).alias("op"), F.lit(e.source_table).alias("source_table"), F.lit(str(seq)).alias("source_sequence"), at.alias("source_commit_ts"), key.alias("key_json"), image.alias("after_json"))

    v, o, c = events(spark, sf_dir), table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    cards = v.select(F.col("event_id").alias("tx_id"), F.col("user_id").alias("account_id"), F.col("event_type").alias("country"), F.col("ts").alias("tx_ts"))
    alone = cards.withColumn("account_id", 10_000_000_000 + F.col("tx_id"))
    transfers = o.select(F.col("o_orderkey").cast("string").alias("transfer_id"), F.col("o_custkey").cast("string").alias("debtor_iban"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").cast("timestamp").alias("booking_ts"))
    accounts = c.select(F.col("c_custkey").alias("account_id"), F.col("c_custkey").cast("string").alias("iban"))
    gold = pipeline.GoldBySlabs(tables, entities)
    batches = [
        sent(entities[0], alone, "c", 1).unionByName(sent(entities[1], transfers, "c", 1)),
        sent(entities[0], cards.where("account_id % 2 = 0"), "u", 2).unionByName(sent(entities[2], accounts, "c", 1)),
        sent(entities[0], cards.where("account_id % 2 = 1"), "u", 2),
    ]
    for i, rows in enumerate(batches):
        tables.append("bronze_change_events", rows, batch=i)
        run_silver(tables, entities, f"{root}/ck/silver", gold.after, gold.before)
    return tables.read("gold_fraud_alerts").select("rule", F.col("account_id").cast("long").alias("account_id"), F.array_join("evidence_keys", ",").alias("evidence"))


def _alert_messages(spark, sf_dir):
    """Alerts as messages; those of every third account are cut short."""
    from tidemark.operators.outbox import alert_json
    from tidemark.streaming.topic_log import message

    a = rules.as_alerts(_velocity(spark, sf_dir), F.lit("2025-01-01 00:00:00").cast("timestamp"))
    text = alert_json(a)
    value = F.when(F.col("account_id") % 3 == 0, F.substring(text, F.lit(1), F.length(text) - 20)).otherwise(text)
    return a.select(*message(value, F.col("account_id").cast("string"), {"schema_version": F.lit("1")}), "account_id")


@query(f"""
WITH a AS (SELECT *, sha256(rule || '|' || account_id || '|' || split_part(evidence, ',', 1)) AS alert_id FROM ({VELOCITY_SQL}))
SELECT CASE WHEN account_id % 3 <> 0 THEN alert_id END AS alert_id, CASE WHEN account_id % 3 <> 0 THEN evidence END AS evidence,
  CASE WHEN account_id % 3 <> 0 THEN replace(first_ts, ' ', 'T') END AS first_ts, account_id % 3 <> 0 AS ok FROM a""")
def alert_messages(spark, sf_dir):
    """The messages of alerts read as the queue reads them: fields of the good ones, and which are good."""
    from tidemark.streaming.queue import readable

    m = readable(_alert_messages(spark, sf_dir))
    good = lambda c: F.when(F.col("ok"), c)
    return m.select(good(F.col("alert_id")).alias("alert_id"), good(F.array_join("evidence_keys", ",")).alias("evidence"), good(F.substring("first_evidence_ts", 1, 19)).alias("first_ts"), "ok")


@query(f"""
WITH a AS (SELECT account_id % 3 <> 0 AS ok FROM ({VELOCITY_SQL}))
SELECT step, CASE WHEN step = 1 THEN count(*) FILTER (WHERE ok) ELSE 0 END AS stored, CASE WHEN step = 1 THEN 0 ELSE count(*) FILTER (WHERE ok) END AS duplicate, count(*) FILTER (WHERE NOT ok) AS rejected
FROM a, (VALUES (1), (2)) t(step) GROUP BY step""")
def queue_consumer(spark, sf_dir):
    """The queue's consumer over a topic of alerts, and over the same alerts sent again; offsets follow the store."""
    from tidemark.service import AlertStore
    from tidemark.streaming.queue import consume
    from tidemark.streaming.topic_log import TopicLog
    from tidemark.tables import Tables

    root = _scratch(spark)
    tables, topics = Tables(spark, f"{root}/tables"), TopicLog(spark, f"{root}/topics")
    tables.ensure()
    topics.ensure(["alerts"])
    store, out = AlertStore(tables), []
    for step in (1, 2):
        topics.append("alerts", _alert_messages(spark, sf_dir).drop("account_id"), ["key", "value"])
        c = consume(store, topics, "alerts", f"{root}/ck")
        out.append((step, c["stored"], c["duplicate"], c["rejected"]))
    return spark.createDataFrame(out, "step INT, stored LONG, duplicate LONG, rejected LONG")


@query("""
WITH t AS (SELECT count(*) AS n, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS b, count(*) FILTER (WHERE c_custkey % 100 = 0) AS lost,
  sum(CAST(c_acctbal AS DECIMAL(18,2))) FILTER (WHERE c_custkey % 100 <> 0) AS have FROM customer),
r AS (SELECT 'row_count' AS check_name, CAST(n AS VARCHAR) AS source_value, CAST(n - lost AS VARCHAR) AS target_value FROM t
  UNION ALL SELECT 'balance_sum', CAST(CAST(b AS DECIMAL(38,2)) AS VARCHAR), CAST(CAST(have AS DECIMAL(38,2)) AS VARCHAR) FROM t
  UNION ALL SELECT 'audit_to_bronze_missing', '0', CAST(lost AS VARCHAR) FROM t)
SELECT *, CASE WHEN source_value = target_value THEN 'PASS' ELSE 'FAIL' END AS status FROM r""")
def reconciliation_run(spark, sf_dir):
    """Source against latest state, and audit against Bronze, where every hundredth change was lost on the way."""
    from tidemark import pipeline
    from tidemark.streaming.silver import Entity, apply_batch
    from tidemark.tables import Tables

    tables = Tables(spark, f"{_scratch(spark)}/tables")
    tables.ensure()
    c = table(spark, sf_dir, "customer").withColumn("balance", F.col("c_acctbal").cast("decimal(18,2)"))
    event = F.sha2(F.col("c_custkey").cast("string"), 256)
    rows = c.select(event.alias("event_id"), F.lit("c").alias("op"), F.lit("customer").alias("source_table"), F.lit("0").alias("source_sequence"), F.lit("2025-01-01").alias("source_commit_ts"), F.to_json(F.struct("c_custkey")).alias("key_json"), identity.row_json(c.schema, ["c_custkey", "balance"]).alias("after_json"), "c_custkey")
    tables.append("cdc_event_audit", rows)
    tables.append("bronze_change_events", rows.where("c_custkey % 100 <> 0"))
    entity = Entity("customer", "silver_customer", ["c_custkey"], "c_custkey BIGINT, balance DECIMAL(18,2)")
    apply_batch(tables, tables.read("bronze_change_events"), entity)
    total = c.agg(F.count("*").alias("n"), F.sum("balance").cast("string").alias("b")).first()
    got = pipeline.run_reconciliation(tables, {"s": [entity]}, {"s": {"customer": {"rows": total["n"], "balance_sum": total["b"]}}}, fail=False)
    return spark.createDataFrame([(r["check_name"], r["source_value"], r["target_value"], r["status"]) for r in got], "check_name STRING, source_value STRING, target_value STRING, status STRING")


@query("""
SELECT 'rows' AS what, CAST(count(*) AS VARCHAR) AS total FROM customer WHERE c_custkey % 7 <> 0
UNION ALL SELECT 'balance', CAST(sum(CAST(c_acctbal AS DECIMAL(18,2)) + CASE WHEN c_custkey % 3 = 0 THEN 1.25 ELSE 0 END) AS VARCHAR) FROM customer WHERE c_custkey % 7 <> 0""")
def totals_by_retraction(spark, sf_dir):
    """Row count and balance of a latest state, kept by what each batch changes: creates, updates that come before their creates, deletes, a replay."""
    from tidemark.streaming.silver import Entity, run_silver
    from tidemark.streaming.totals import Totals
    from tidemark.tables import Tables

    root = _scratch(spark)
    tables = Tables(spark, f"{root}/tables")
    tables.ensure()
    e = Entity("customer", "silver_customer", ["c_custkey"], "c_custkey BIGINT, balance DECIMAL(18,2)")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    kept = Totals(tables, [e])

    def sent(rows: DataFrame, op: str, seq: int) -> DataFrame:
        key = F.to_json(F.struct("c_custkey"))
        return rows.select(F.concat_ws(":", key, F.lit(seq)).alias("event_id"), F.lit(op).alias("op"), F.lit(e.source_table).alias("source_table"), F.lit(str(seq)).alias("source_sequence"), F.current_timestamp().alias("source_commit_ts"), key.alias("key_json"), (F.lit(None) if op == "d" else F.to_json(F.struct("c_custkey", "balance"))).cast("string").alias("after_json"))

    more = c.where("c_custkey % 3 = 0").withColumn("balance", (F.col("balance") + F.lit("1.25").cast("decimal(18,2)")).cast("decimal(18,2)"))
    gone = sent(c.where("c_custkey % 7 = 0"), "d", 3)
    batches = [sent(c.where("c_custkey % 2 = 0"), "c", 1).unionByName(sent(more, "u", 2)), sent(c, "c", 1), gone, gone.unionByName(sent(more, "u", 2))]
    for i, rows in enumerate(batches):
        tables.append("bronze_change_events", rows, batch=i)
        run_silver(tables, [e], f"{root}/ck/silver", before=kept.before)
    got = kept.read(e)
    return spark.createDataFrame([("rows", str(got["rows"])), ("balance", str(got["balance"]))], "what STRING, total STRING")


@query("""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN '1.250,00' ELSE '12.50' END AS amount FROM orders)
SELECT CASE WHEN try_cast(amount AS DECIMAL(38,18)) IS NULL THEN 'invalid amount' ELSE 'event' END AS what, count(*) AS n, count(DISTINCT o_orderkey) AS ids FROM t GROUP BY 1""")
def file_capture(spark, sf_dir):
    """Orders written as CSV files of a partner and captured from the folder: events, and refused records."""
    from tidemark.sources.file_drop import TRANSFER_COLUMNS, FileDropSource

    folder = f"{_scratch(spark)}/drop"
    o = table(spark, sf_dir, "orders")
    values = {"transfer_id": F.col("o_orderkey").cast("string"), "debtor_iban": F.lit("GB82WEST12345698765432"), "creditor_iban": F.lit("DE89370400440532013000"), "amount": F.when(F.col("o_orderkey") % 4 == 1, "1.250,00").otherwise("12.50"), "booking_ts": F.col("o_orderdate").cast("string"), "currency": F.lit("EUR"), "reference": F.lit('a "quoted", reference')}
    rows = o.repartition(4).select(*[values.get(c, F.lit("x")).alias(c) for c in TRANSFER_COLUMNS])
    rows.write.option("header", "true").option("escape", '"').csv(folder)
    got = FileDropSource(spark, folder).capture(None, "t")
    ids = got.events.select(F.lit("event").alias("what"), F.get_json_object("key", "$.transfer_id").alias("id"))
    refused = got.rejects.select(F.col("reason").alias("what"), F.split_part("raw", F.lit(","), F.lit(1)).alias("id"))
    return ids.unionByName(refused).groupBy("what").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '5" pipe' WHEN 1 THEN 'a "quoted", reference' WHEN 2 THEN 'two' || chr(10) || 'lines, "x"' WHEN 3 THEN 'closed and "more' ELSE '' END AS reference FROM orders""")
def file_capture_quotes(spark, sf_dir):
    """Orders written as one file, with quotes within plain fields, doubled ones, line ends within quotes and text behind a closing quote; captured from it."""
    from tidemark.sources.file_drop import TRANSFER_COLUMNS, FileDropSource, Folder

    folder, key = f"{_scratch(spark)}/drop", F.col("o_orderkey")
    reference = F.when(key % 5 == 0, '5" pipe').when(key % 5 == 1, '"a ""quoted"", reference"').when(key % 5 == 2, '"two\nlines, ""x"""').when(key % 5 == 3, '"closed" and "more').otherwise("")
    values = {"transfer_id": key.cast("string"), "debtor_iban": F.lit("GB82WEST12345698765432"), "creditor_iban": F.lit("DE89370400440532013000"), "amount": F.lit("12.50"), "booking_ts": F.col("o_orderdate").cast("string"), "currency": F.lit("EUR"), "reference": reference}
    record = F.concat_ws(",", *[values.get(c, F.lit("x")) for c in TRANSFER_COLUMNS])
    head = spark.range(1).select(F.lit(0).alias("nth"), F.lit(",".join(TRANSFER_COLUMNS)).alias("value"))
    lines = head.unionByName(table(spark, sf_dir, "orders").select(F.lit(1).alias("nth"), record.alias("value")))
    lines.repartition(1).sortWithinPartitions("nth").select("value").write.text(folder)
    got = FileDropSource(spark, Folder(spark, folder, ".txt")).capture(None, "t").events
    return got.select(F.get_json_object("key", "$.transfer_id").cast("long").alias("o_orderkey"), F.get_json_object("after", "$.reference").alias("reference"))


@query("""
SELECT count(DISTINCT k) AS ids FROM (
  SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 8 = 0 AND o_orderkey % 5 <> 0
  UNION ALL SELECT -o_orderkey FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0)""")
def file_stats(spark, sf_dir):
    """A file source's distinct valid ids: of files taken before from what is kept of them, of one that came again without half of its rows, of one that wasn't
    taken yet by reading it; every fifth row has no valid amount."""
    from tidemark import pipeline
    from tidemark.sources.file_drop import TRANSFER_COLUMNS, FileDropSource
    from tidemark.tables import Tables

    root, key = _scratch(spark), F.col("o_orderkey")
    tables = Tables(spark, f"{root}/tables")
    values = {"debtor_iban": F.lit("GB82WEST12345698765432"), "creditor_iban": F.lit("DE89370400440532013000"), "amount": F.when(key % 5 == 0, "none").otherwise("12.50"), "booking_ts": F.col("o_orderdate").cast("string")}

    def put(name: str, where: str, sign: int = 1) -> None:
        rows = table(spark, sf_dir, "orders").where(where).select(*[values.get(c, F.lit("x")) if c != "transfer_id" else (sign * key).cast("string").alias(c) for c in TRANSFER_COLUMNS]).toDF(*TRANSFER_COLUMNS)
        rows.coalesce(1).write.option("header", "true").csv(f"{root}/made/{name}")
        files = tables.files
        made = next(f for f in files.names(f"{root}/made/{name}") if f.endswith(".csv"))
        files.delete(f"{root}/drop/{name[:2]}.csv")
        files.rename(f"{root}/made/{name}/{made}", f"{root}/drop/{name[:2]}.csv")

    source = FileDropSource(spark, f"{root}/drop", manifest=lambda: taken, ids=lambda: pipeline.file_ids(tables, "drop"))
    taken = None
    for step in (0, 1):
        for part in range(4) if step == 0 else (0,):
            put(f"p{part}-{step}", f"o_orderkey % 4 = {part}" if step == 0 else "o_orderkey % 8 = 0")
        got = source.capture(None, "t")
        pipeline.keep_ids(tables, "drop", got.ids)
        taken = got.manifest.select("file_name", "etag") if taken is None else taken.unionByName(got.manifest.select("file_name", "etag"))
    put("q0", "o_orderkey % 3 = 0", -1)
    return spark.createDataFrame([(source.stats()["partner_transfers"]["rows"],)], "ids LONG")


@query("SELECT o_orderkey, 'c' AS op, 'partner-drop' AS source_database FROM orders UNION ALL SELECT o_orderkey, 'u', 'partner-drop' FROM orders WHERE o_orderkey % 4 = 0")
def file_capture_share(spark, sf_dir):
    """Orders in files of a share with a client of its own, which executors download in chunks; one of the four files comes again, changed."""
    from tidemark.sources.file_drop import TRANSFER_COLUMNS, FileDropSource, RemoteShare

    folder = f"{_scratch(spark)}/share"
    key = F.col("o_orderkey")
    values = {"transfer_id": key.cast("string"), "debtor_iban": F.lit("GB82WEST12345698765432"), "creditor_iban": F.lit("DE89370400440532013000"), "amount": F.lit("12.50"), "booking_ts": F.col("o_orderdate").cast("string"), "currency": F.lit("EUR")}

    def put(version: str, where: str) -> None:
        rows = table(spark, sf_dir, "orders").where(where).select((key % 4).alias("part"), *[values.get(c, F.lit(version)).alias(c) for c in TRANSFER_COLUMNS])
        rows.repartition("part").write.mode("append").option("header", "true").partitionBy("part").csv(f"{folder}/{version}")

    class Client:
        """Of a share whose names are the part and the version."""

        def __init__(self, versions, name=None):
            self.versions, self.name = versions, name

        def _paths(self, part):
            import pyarrow.fs

            fs, root = pyarrow.fs.FileSystem.from_uri(f"{folder}/{self.versions[part]}/part={part}")
            return fs, [i.path for i in fs.get_file_info(pyarrow.fs.FileSelector(root)) if i.path.endswith(".csv")][0]

        def list_directories_and_files(self):
            return [{"name": f"{p}.csv", "is_directory": False} for p in self.versions]

        def get_file_client(self, name):
            return Client(self.versions, name)

        def get_file_properties(self):
            from datetime import datetime
            from types import SimpleNamespace

            part = int(self.name.split(".")[0])
            fs, path = self._paths(part)
            return SimpleNamespace(etag=f'"{self.versions[part]}"', size=fs.get_file_info(path).size, last_modified=datetime(2025, 1, 1))

        def download_file(self):
            return self

        def chunks(self):
            fs, path = self._paths(int(self.name.split(".")[0]))
            with fs.open_input_stream(path) as f:
                while data := f.read(100_000):
                    yield data

    put("first", "true")
    put("second", "o_orderkey % 4 = 0")
    taken, out = None, None
    for versions in ({p: "first" for p in range(4)}, {0: "second"} | {p: "first" for p in range(1, 4)}):
        got = FileDropSource(spark, RemoteShare(spark, lambda v=versions: Client(v)), manifest=lambda: taken).capture(None, "t")
        events = got.events.select(F.get_json_object("key", "$.transfer_id").cast("long").alias("o_orderkey"), "op", F.col("source.database").alias("source_database"))
        taken, out = got.manifest.select("file_name", "etag"), events if out is None else out.unionByName(events)
    return out


@query("""
SELECT table_name AS tab, string_agg(column_name || ' ' || CASE data_type WHEN 'INTEGER' THEN 'INT' WHEN 'VARCHAR' THEN 'STRING' ELSE data_type END, ', ' ORDER BY ordinal_position) AS columns
FROM information_schema.columns WHERE table_name IN ('region', 'nation', 'customer', 'orders', 'events') GROUP BY table_name""")
def ddl_silver_schema(spark, sf_dir):
    """CREATE TABLE statements of five tables, read into the schema of their latest state."""
    from tidemark.onboarding.ddl import parse, silver_schema

    sql = {"bigint": "BIGINT", "int": "INTEGER", "string": "NVARCHAR(200)", "double": "DOUBLE PRECISION", "timestamp": "DATETIME2(6)", "timestamp_ntz": "DATETIME2(6)"}
    out = []
    for name in ("region", "nation", "customer", "orders", "events"):
        fields = [(f.name, sql[f.dataType.simpleString()]) for f in table(spark, sf_dir, name).schema]
        text = f"CREATE TABLE [dbo].[{name}] (" + ", ".join(f"[{n}] {t} NOT NULL /* , */" for n, t in fields) + f", CONSTRAINT pk PRIMARY KEY ([{fields[0][0]}]))"
        out.append((name, silver_schema(parse(text))))
    return spark.createDataFrame(out, "tab STRING, columns STRING")
