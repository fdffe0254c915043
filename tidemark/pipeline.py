"""The platform's steps: capture, rules, publishing, reconciliation.

Capture delivers in a fixed order (events, then audit, then manifest and state, the watermark last), so a crash replays the same
range with the same event ids, which Bronze stores once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import outbox, quality, rules, set_sketch
from tidemark.sources.base import REJECT, Source, event_json
from tidemark.streaming import slabs
from tidemark.streaming.postings import Postings
from tidemark.streaming.silver import Entity, view
from tidemark.streaming.topic_log import TopicLog, message
from tidemark.streaming.totals import Totals
from tidemark.tables import Tables
from tidemark.types import schema

# Fixed values.
CARDS, TRANSFERS, ACCOUNTS = "dbo.card_transactions", "partner_transfers", "dbo.accounts"
LINEAGE = {"card_velocity": (CARDS, "tx_id"), "impossible_travel": (CARDS, "tx_id"), "structuring": (TRANSFERS, "transfer_id")}


class ReconciliationError(RuntimeError):
    pass


def read_watermark(tables: Tables, source: str) -> dict[str, Any] | None:
    rows = tables.read("cdc_control").where(F.col("source_name") == source).select("watermark").take(1)
    return json.loads(rows[0]["watermark"]) if rows else None


def publish(topics: TopicLog, events: DataFrame | None, topic_of: dict[str, str], rejects: DataFrame | None, dlq: str, source: str) -> DataFrame | None:
    """Writes events to the topics of their tables and refused rows to the dead-letter topic; returns the audit rows."""
    audit = None
    if events is not None:
        for table, topic in sorted(topic_of.items()):
            mine = events.where(F.col("source.table") == table)
            headers = {"event_id": F.col("event_id"), "schema_version": F.col("schema_version")}
            rows = mine.select(*message(event_json(), F.col("topic_key"), headers), "event_id", "op", F.col("source.table").alias("source_table"), F.col("source.position").alias("source_position"), F.col("source.commit_ts").alias("source_commit_ts"), "payload_hash", "trace_id", F.coalesce("source.sequence", "source.position").alias("seq"))
            w = topics.append(topic, rows, ["seq", "event_id"])
            a = w.select("event_id", F.lit(source).alias("source_name"), "source_table", "op", "source_position", F.try_to_timestamp("source_commit_ts").alias("source_commit_ts"), "payload_hash", "topic", F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), "trace_id", F.col("timestamp").alias("produced_at"))
            audit = a if audit is None else audit.unionByName(a)
    if rejects is not None and not rejects.isEmpty():
        body = F.to_json(F.struct(*[c.split()[0] for c in REJECT.split(", ")]), {"ignoreNullFields": "false"})
        topics.append(dlq, rejects.select(*message(body, F.col("position"), {"kind": F.lit("reject")})), ["key"])
    return audit


def known_table(tables: Tables, source: str, table: str) -> DataFrame | None:
    """What a query-based source knew of a table's rows after its last run."""
    name = f"known__{source}__{table}"
    return tables.read(name) if tables.exists(name) else None


def file_ids(tables: Tables, source: str) -> DataFrame | None:
    """file_name, etag, id: what a file source gave of each file that it took last."""
    name = f"ids__{source}"
    return tables.read(name) if tables.exists(name) else None


def keep_ids(tables: Tables, source: str, ids: DataFrame) -> None:
    """A file that comes again takes its old ids back."""
    ids = ids.persist()
    try:
        tables.merge(f"ids__{source}", ids, ["file_name"], lambda old, new: new if old is None else old.join(new.select("file_name").distinct(), "file_name", "left_anti").unionByName(new))
    finally:
        ids.unpersist()


def run_capture(tables: Tables, topics: TopicLog, source: Source, topic_of: dict[str, str], dlq: str, trace_id: str | None = None) -> dict[str, Any]:
    trace, began = trace_id or str(uuid.uuid4()), datetime.now(UTC)
    got = source.capture(read_watermark(tables, source.name), trace)
    events = got.events.persist() if got.events is not None else None
    try:
        audit = publish(topics, events, topic_of, got.rejects, dlq, source.name)
        if audit is not None:
            tables.append("cdc_event_audit", audit)
        if got.manifest is not None:
            tables.append("cdc_file_manifest", got.manifest.withColumn("processed_at", F.current_timestamp()))
        if got.ids is not None:
            keep_ids(tables, source.name, got.ids)
        for table, k in got.known.items():
            name = f"known__{source.name}__{table}"
            if k.news is None:
                tables.replace(name, k.rows, k.keys)
            else:
                news = k.news.persist()
                tables.merge(name, news, k.keys, k.add)
                news.unpersist()
        ops = {r["op"]: r["count"] for r in events.groupBy("op").count().collect()} if events is not None else {}
        n_rejects = got.rejects.count() if got.rejects is not None else 0
        n_files = got.manifest.count() if got.manifest is not None else 0
        row = [(source.name, json.dumps(got.watermark, sort_keys=True), trace, sum(ops.values()), n_rejects, "OK", datetime.now(UTC).isoformat())]
        control = tables.spark.createDataFrame(row, "source_name STRING, watermark STRING, last_trace_id STRING, events_captured BIGINT, rejects BIGINT, status STRING, updated_at STRING")
        tables.upsert("cdc_control", control, ["source_name"])
    finally:
        if events is not None:
            events.unpersist()
    return {"source_name": source.name, "trace_id": trace, "events": sum(ops.values()), "rejects": n_rejects, "ops": ops, "files": n_files, "seconds": (datetime.now(UTC) - began).total_seconds()}


def touched_moments(batch: DataFrame, entities: dict[str, Entity], transfers: DataFrame, accounts: DataFrame) -> dict[str, DataFrame]:
    """Of a batch of raw events, per rule input the (account_id, ts) whose alerts it can change: where a row is and where it was, by
    the images of each change; and all transfers of an account whose IBAN is new to it. `entities` are by source table.

    A change whose image before is missing, as a polled source gives none, leaves only the place where the row was unseen.
    """

    def images(table: str, where: str = "true") -> DataFrame:
        s = schema(entities[table].columns)
        mine = batch.where(F.col("source_table") == table).select(F.from_json("before_json", s).alias("before"), F.from_json("after_json", s).alias("after")).where(where)
        return mine.select(F.explode(F.array_compact(F.array("before", "after"))).alias("i")).select("i.*")

    cards = images(CARDS).select("account_id", F.col("tx_ts").alias("ts"))
    named = images(TRANSFERS).select("debtor_iban", F.col("booking_ts").alias("ts"))
    moved = images(ACCOUNTS, "not before.iban <=> after.iban").select("iban", "account_id").distinct()
    late = rules.owned(transfers.select("debtor_iban", F.col("booking_ts").alias("ts")), moved)
    both = rules.owned(named, accounts).unionByName(late).select("account_id", "ts")
    return {"cards": cards, "transfers": both}


def gold_after(tables: Tables, entities: list[Entity]) -> Callable[[DataFrame], None]:
    """For run_silver: alerts that each batch of raw events can change, made anew after its state is stored. Run from the first
    batch on, it keeps what run_gold finds over all history at the end of each."""
    by = {e.source_table: e for e in entities}

    def after(batch: DataFrame) -> None:
        cards, transfers, accounts = (view(tables, by[t]) for t in (CARDS, TRANSFERS, ACCOUNTS))
        store_alerts(tables, found_alerts(cards, transfers, accounts, touched_moments(batch, by, transfers, accounts)))

    return after


class GoldBySlabs:
    """For run_silver, as `before` and `after`: alerts that a batch can change, made anew from the slabs around what it changed.

    Run from the first batch on, it keeps what run_gold finds over all history at the end of each batch, as gold_after does; but cards and
    transfers are read by slab, and where a row was comes from the state, so sources need no image before. Accounts, of which there
    are far fewer, are read whole, and so are transfers when an account's IBAN changes.
    """

    def __init__(self, tables: Tables, entities: list[Entity], parts: int = slabs.PARTS):
        self.tables, self.by = tables, {e.source_table: e for e in entities}
        self.cards = slabs.Slabs(self.by[CARDS], "account_id", "tx_ts", rules.SLAB * rules.TRAVEL_S, parts)
        self.transfers = slabs.Slabs(self.by[TRANSFERS], "debtor_iban", "booking_ts", rules.SLAB * rules.STRUCTURING_S, parts)
        self.changed: dict[str, DataFrame] = {}

    def before(self, batch: DataFrame, name: str) -> None:
        self.changed = {t: slabs.noted(self.tables, batch, self.by[t], name) for t in (CARDS, TRANSFERS, ACCOUNTS)}
        self.cards.merge(self.tables, self.changed[CARDS])
        self.transfers.merge(self.tables, self.changed[TRANSFERS])

    def touched(self) -> dict[str, DataFrame]:
        """Per rule input the (account_id, ts) whose alerts the last batch can change."""
        accounts = view(self.tables, self.by[ACCOUNTS])
        cards = slabs.images(self.changed[CARDS], "account_id", "tx_ts").withColumnRenamed("tx_ts", "ts")
        named = slabs.images(self.changed[TRANSFERS], "debtor_iban", "booking_ts").withColumnRenamed("booking_ts", "ts")
        both = rules.owned(named, accounts)
        moved = slabs.images(self.changed[ACCOUNTS].where("not (was.iban <=> now.iban)"), "iban", "account_id").where("iban is not null").distinct()
        if self.tables.exists(self.transfers.name) and not moved.isEmpty():
            theirs = self.transfers.of_owners(self.tables, moved.select(F.col("iban").alias("debtor_iban")))
            both = both.unionByName(rules.owned(theirs.select("debtor_iban", F.col("booking_ts").alias("ts")), moved))
        return {"cards": cards, "transfers": both.select("account_id", "ts")}

    def after(self, batch: DataFrame) -> None:
        t = {k: df.distinct().persist() for k, df in self.touched().items()}
        near = f"{self.tables.path(self.cards.name)}__near-{uuid.uuid4().hex}"
        try:
            accounts = view(self.tables, self.by[ACCOUNTS])
            some = lambda s, moments, reach: s.around(self.tables, moments, reach) if self.tables.exists(s.name) else view(self.tables, s.entity)
            cards = some(self.cards, t["cards"].withColumnRenamed("account_id", "owner"), max(rules.reach_of_bursts(rules.VELOCITY_S), rules.reach_of_changes(rules.TRAVEL_S)))
            cards = self.tables.files_of(cards, near)  # two rules read them
            owners = t["transfers"].join(accounts.select("account_id", F.col("iban").alias("owner")), "account_id").select("owner", "ts")
            transfers = some(self.transfers, owners, rules.reach_of_bursts(rules.STRUCTURING_S))
            store_alerts(self.tables, found_alerts(cards, transfers, accounts, t))
        finally:
            self.tables.files.delete(near)
            for df in t.values():
                df.unpersist()


def found_alerts(cards: DataFrame, transfers: DataFrame, accounts: DataFrame, touched: dict[str, DataFrame] | None = None) -> DataFrame:
    """Alerts of all rules over these rows, or over what touched moments of `cards` and `transfers` reach."""
    t = touched or {}
    velocity, travel = rules.card_velocity(cards, touched=t.get("cards")), rules.impossible_travel(cards, touched=t.get("cards"))
    return rules.as_alerts(rules.union_rules(velocity, travel, rules.structuring(transfers, accounts, touched=t.get("transfers"))))


def store_alerts(tables: Tables, found: DataFrame) -> None:
    """Known alerts get new evidence, new ones are added; only buckets with such alerts are written."""
    keep = [c for c in found.columns if c not in ("alert_id", "evidence_keys")]
    have = tables.read("gold_fraud_alerts").select("alert_id", "evidence_keys")
    news = found.dropDuplicates(["alert_id"]).join(have, ["alert_id", "evidence_keys"], "left_anti").select(*found.columns).persist()
    try:
        tables.upsert("gold_fraud_alerts", news, ["alert_id"], keep)
    finally:
        news.unpersist()


def run_gold(tables: Tables, cards: DataFrame, transfers: DataFrame, accounts: DataFrame, touched: dict[str, DataFrame] | None = None) -> int:
    """All rules over the latest state, or over what touched moments of `cards` and `transfers` reach; known alerts get new
    evidence, new ones are added, and only buckets with such alerts are written. Returns how many there are."""
    store_alerts(tables, found_alerts(cards, transfers, accounts, touched))
    return tables.read("gold_fraud_alerts").count()


def publish_pending_alerts(tables: Tables, topics: TopicLog, topic: str) -> int:
    """Sends alerts that were not sent yet and stamps those that were written."""
    due = outbox.pending(tables.read("gold_fraud_alerts"))
    if due.isEmpty():
        return 0
    rows = due.select(*message(outbox.alert_json(due), F.col("account_id").cast("string"), {"alert_id": F.col("alert_id"), "schema_version": F.lit("1")}), "alert_id")
    sent = topics.append(topic, rows, ["alert_id"])
    n = sent.count()
    tables.merge("gold_fraud_alerts", sent.select("alert_id"), ["alert_id"], outbox.stamped)
    return n


def snapshot_pending(tables: Tables, source: str) -> bool:
    """Whether deletes at a query-based source may not have been seen yet."""
    return (read_watermark(tables, source) or {}).get("runs_since_snapshot", 0) != 0


def run_reconciliation(tables: Tables, entities: dict[str, list[Entity]], stats: dict[str, dict[str, dict[str, Any]]], query_based: set[str] = frozenset(), fail: bool = True, totals: Totals | None = None) -> list[dict[str, Any]]:
    """Counts (and balances) of sources against live latest-state rows, and delivered against stored events. totals: those that the batches kept, in place
    of a scan of each state.

    Results are stored before a failure is raised. While a snapshot is due, counts of that source are SKIP.
    """
    spark, run_id = tables.spark, str(uuid.uuid4())
    checks = []
    for source, own in entities.items():
        late = source in query_based and snapshot_pending(tables, source)
        for e in own:
            want = stats[source][e.source_table]
            have = totals.read(e) if totals else Totals(tables, [e]).counted(e)
            checks.append((source, e.source_table, "row_count", str(want["rows"]), str(have["rows"]), late))
            if "balance_sum" in want:
                checks.append((source, e.source_table, "balance_sum", str(spark.sql(f"select cast('{want['balance_sum']}' as decimal(38,2))").first()[0]), str(have["balance"] if have["balance"] is not None else "0.00"), False))
    lost = set_sketch.missing(tables, "cdc_event_audit", "bronze_change_events").count()
    checks.append(("*", "*", "audit_to_bronze_missing", "0", str(lost), False))
    df = spark.createDataFrame(checks, "source_name STRING, table_name STRING, check_name STRING, source_value STRING, target_value STRING, skip BOOLEAN")
    df = df.select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("checked_at"), "source_name", "table_name", "check_name", "source_value", "target_value", quality.verdict(F.col("source_value"), F.col("target_value"), F.col("skip")).alias("status"))
    tables.append("dq_reconciliation", df, batch=run_id)
    out = [r.asDict() for r in tables.read("dq_reconciliation").where(F.col("run_id") == run_id).collect()]
    failed = [r for r in out if r["status"] == "FAIL"]
    if failed and fail:
        raise ReconciliationError(f"{len(failed)} checks failed: " + "; ".join(f"{r['table_name']} {r['check_name']} {r['source_value']} <> {r['target_value']}" for r in failed))
    return out


def run_lineage(tables: Tables, alerts: DataFrame) -> DataFrame:
    """Every stored source change behind the alerts, from the batches that hold their evidence."""
    return Postings(tables, set(LINEAGE.values())).lineage(alerts, LINEAGE)
