"""python -m tidemark.demo --rounds 6 --customers 150 --seed 2026 --root /tmp/bank --out metrics.json

Runs the whole platform over the simulated bank and writes its metrics: seconds of each step, latencies from
commit to alert and to the queue, events by table and op, refused rows, reconciliation and detection scores.
"""

from __future__ import annotations

import argparse
import json
import os
import time
from datetime import datetime, timedelta
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config, pipeline
from tidemark.operators import quality
from tidemark.service import AlertStore
from tidemark.session import build_session
from tidemark.simulate import Bank
from tidemark.sources.change_log import ChangeLogSource, LogTable
from tidemark.sources.file_drop import FileDropSource
from tidemark.sources.row_versions import RowVersionSource, VersionedRows
from tidemark.streaming import bronze, queue, silver
from tidemark.streaming.topic_log import TopicLog
from tidemark.tables import Tables


class Platform:
    """The simulated bank's sources wired to tables and topics below one folder."""

    def __init__(self, spark: SparkSession, root: str | Path, bank: Bank, cfg: dict[str, Any] | None = None):
        self.spark, self.root, self.bank, self.cfg = spark, Path(root), bank, cfg or config.load()
        self.tables, self.topics = Tables(spark, f"{root}/tables"), TopicLog(spark, f"{root}/topics")
        self.tables.ensure()
        self.topics.ensure(config.all_topics(self.cfg))
        self.folder = self.root / "drop"
        self.folder.mkdir(parents=True, exist_ok=True)
        self.dlq, self.alerts_topic = self.cfg["kafka"]["dlq_topic"], self.cfg["kafka"]["alerts_topic"]
        ddl = {e.source_table: e.columns for e in config.all_entities(self.cfg)}
        short = lambda t: t.split(".")[1]
        logged = [LogTable(t["schema"], t["table"], t["primary_key"]) for t in self.cfg["sources"]["sqlserver_cards"]["tables"]]
        self.log = ChangeLogSource("sqlserver_cards", "cards", logged, lambda t: bank.log_rows(spark, short(t), ddl[t]), bank.max_lsn, lambda t: (1).to_bytes(10, "big"), lambda t: bank.current_rows(spark, short(t), ddl[t]))
        polled = [VersionedRows("CORE", "LOANS", ["LOAN_ID"], "ROW_CHANGED")]
        self.loans = RowVersionSource("db2_core", "COREBANK", polled, lambda t: bank.loan_rows(spark, ddl[t]), lambda: bank.now + timedelta(seconds=10), lambda t: pipeline.known_table(self.tables, "db2_core", t), self.cfg["sources"]["db2_core"]["snapshot_every"])
        self.drop = FileDropSource(spark, str(self.folder), manifest=lambda: self.tables.read("cdc_file_manifest"), ids=lambda: pipeline.file_ids(self.tables, "partner_fileshare"))
        self.sources = [self.log, self.loans, self.drop]

    def capture(self) -> dict[str, dict[str, Any]]:
        self.bank.write_files(self.folder)
        return {s.name: pipeline.run_capture(self.tables, self.topics, s, config.topics_of(self.cfg["sources"][s.name]), self.dlq) for s in self.sources}

    def load(self) -> None:
        names = [t for s in self.cfg["sources"].values() for t in config.topics_of(s).values()]
        bronze.run_bronze(self.tables, self.topics, names, f"{self.root}/checkpoints/bronze", self.dlq)
        silver.run_silver(self.tables, config.all_entities(self.cfg), f"{self.root}/checkpoints/silver")

    def view(self, name: str) -> DataFrame:
        return silver.view(self.tables, next(e for e in config.all_entities(self.cfg) if e.silver_table == name))

    def gold(self) -> int:
        return pipeline.run_gold(self.tables, self.view("silver_card_transactions"), self.view("silver_partner_transfers"), self.view("silver_accounts"))

    def reconcile(self, fail: bool = True) -> list[dict[str, Any]]:
        stats = {s.name: s.stats() for s in self.sources}
        entities = {n: config.entities_of(s) for n, s in self.cfg["sources"].items()}
        return pipeline.run_reconciliation(self.tables, entities, stats, {"db2_core"}, fail)

    def publish(self) -> int:
        return pipeline.publish_pending_alerts(self.tables, self.topics, self.alerts_topic)

    def consume(self, store: AlertStore, checkpoint: str = "queue") -> dict[str, int]:
        return queue.consume(store, self.topics, self.alerts_topic, f"{self.root}/checkpoints/{checkpoint}")

    def scores(self) -> DataFrame:
        return quality.scores(self.tables.read("gold_fraud_alerts"), self.bank.truth_rows(self.spark))


def run(spark: SparkSession, root: str, rounds: int, customers: int, seed: int) -> dict[str, Any]:
    p = Platform(spark, root, Bank(seed, datetime(2026, 10, 1, 9), customers))
    p.bank.open()
    store, steps, checks = AlertStore(p.tables), [], []
    for k in range(rounds + 1):
        took: dict[str, Any] = {"round": k}

        def timed(name: str, f, took=took):
            began = time.monotonic()
            out = f()
            took[name] = round(time.monotonic() - began, 2)
            return out

        took["captured"] = {n: c["events"] for n, c in timed("capture", p.capture).items()}
        timed("load", p.load)
        timed("gold", p.gold)
        timed("publish", p.publish)
        timed("queue", lambda: p.consume(store))
        checks += timed("reconcile", lambda: p.reconcile(fail=False))
        steps.append(took)
        if k < rounds:
            p.bank.hour()
    alerts = p.tables.read("gold_fraud_alerts")
    ops = p.tables.read("bronze_change_events").groupBy("source_system", "source_table", "op").count().orderBy("source_system", "source_table", "op")
    latency = p.tables.read("bronze_change_events").select(((F.unix_micros("ingested_at") - F.unix_micros("captured_at")) / 1e6).alias("s"))
    at = lambda c: F.unix_micros(F.try_to_timestamp(F.col(c)))
    queued = p.tables.read(store.table).select(((at("received_at") - at("last_source_commit_ts")) / 1e6).alias("s"))
    return {
        "rounds": rounds,
        "customers": customers,
        "seed": seed,
        "steps": steps,
        "capture_to_bronze_seconds": quality.percentiles(latency, "s").first().asDict(),
        "commit_to_alert_seconds": quality.percentiles(alerts, "latency_seconds").first().asDict(),
        "commit_to_queue_seconds": quality.percentiles(queued, "s").first().asDict(),
        "events": [r.asDict() for r in ops.collect()],
        "refused": p.topics.read(p.dlq).count(),
        "alerts": {r["rule"]: r["count"] for r in alerts.groupBy("rule").count().collect()},
        "queue": store.stats(),
        "scores": [r.asDict() for r in p.scores().orderBy("rule").collect()],
        "reconciliation": {s: sum(c["status"] == s for c in checks) for s in ("PASS", "FAIL", "SKIP")},
    }


def main(argv: list[str] | None = None) -> int:
    a = argparse.ArgumentParser(prog="tidemark.demo", description=__doc__)
    a.add_argument("--rounds", type=int, default=6)
    a.add_argument("--customers", type=int, default=150)
    a.add_argument("--seed", type=int, default=2026)
    a.add_argument("--root", required=True)
    a.add_argument("--out", required=True, type=Path)
    o = a.parse_args(argv)
    spark = build_session("demo", os.environ.get("SPARK_MASTER", "local[4]"), spark__sql__shuffle__partitions="4", spark__ui__enabled="false")
    metrics = run(spark, o.root, o.rounds, o.customers, o.seed)
    o.out.write_text(json.dumps(metrics, indent=1), encoding="utf-8")
    return int(metrics["reconciliation"]["FAIL"] > 0)


if __name__ == "__main__":
    raise SystemExit(main())
