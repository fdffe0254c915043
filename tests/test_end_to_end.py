"""The whole platform over the simulated bank: replay equals source, planted cases are found, reconciliation passes."""

import json
import threading
import urllib.request
from datetime import datetime

import pytest

from tidemark import pipeline
from tidemark.demo import Platform
from tidemark.service import AlertStore, answer, serve
from tidemark.simulate import Bank


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    bank = Bank(seed=11, now=datetime(2026, 10, 1, 9), customers=25, card_payments=40, transfers=8)
    w = Platform(spark, tmp_path_factory.mktemp("world"), bank)
    w.bank.open()
    first = w.capture()
    w.load()
    assert first["sqlserver_cards"]["ops"]["c"] == len(w.bank.tables["customers"]) + len(w.bank.tables["accounts"])
    for _ in range(3):
        w.bank.hour()
        w.capture()
    w.load()
    w.n_alerts = w.gold()
    return w


def test_replayed_changes_equal_the_sources(world):
    for table, name, key in (("customers", "silver_customers", "customer_id"), ("accounts", "silver_accounts", "account_id"), ("card_transactions", "silver_card_transactions", "tx_id")):
        live = {r[key]: r.asDict() for r in world.view(name).where("not _is_deleted").collect()}
        want = world.bank.tables[table]
        assert live.keys() == want.keys()
        for k, row in want.items():
            assert {c: live[k][c] for c in row} == row
    deleted = world.view("silver_card_transactions").where("_is_deleted").collect()
    assert deleted and all(r["merchant"] for r in deleted)  # the last values stay


def test_loans_follow_with_hard_deletes(world):
    live = {r["LOAN_ID"]: r for r in world.view("silver_loans").where("not _is_deleted").collect()}
    assert live.keys() == world.bank.loans.keys()
    assert all(live[k]["OUTSTANDING"] == v["OUTSTANDING"] for k, v in world.bank.loans.items())


def test_reconciliation_passes_and_is_stored(world):
    checks = world.reconcile()
    assert {c["status"] for c in checks} == {"PASS"}
    assert {c["check_name"] for c in checks} == {"row_count", "balance_sum", "audit_to_bronze_missing"}


def test_planted_cases_are_all_found(world):
    s = {r["rule"]: r for r in world.scores().collect()}
    assert {t["rule"] for t in world.bank.truth} == {"card_velocity", "impossible_travel", "structuring"}
    for rule in {t["rule"] for t in world.bank.truth}:
        assert s[rule]["recall"] == 1.0


def test_rules_again_change_nothing(world):
    before = {r["alert_id"]: r["alert_created_at"] for r in world.tables.read("gold_fraud_alerts").collect()}
    assert world.gold() == world.n_alerts
    assert {r["alert_id"]: r["alert_created_at"] for r in world.tables.read("gold_fraud_alerts").collect()} == before


def test_a_second_load_finds_nothing_new(world):
    n = world.tables.read("bronze_change_events").count()
    world.capture()
    world.load()
    assert world.tables.read("bronze_change_events").count() == n


def test_refused_rows_are_in_the_dead_letter_topic(world):
    dlq = world.topics.read(world.dlq).collect()
    assert len(dlq) == world.bank.refused > 0 and all("invalid amount" in r["value"] for r in dlq)


def test_offsets_are_gapless(world):
    rows = world.tables.read("cdc_event_audit").groupBy("topic", "kafka_partition").agg({"kafka_offset": "max", "*": "count"}).collect()
    assert rows and all(r["max(kafka_offset)"] + 1 == r["count(1)"] for r in rows)


def test_lineage_leads_to_stored_changes(world):
    a = world.tables.read("gold_fraud_alerts").where("rule = 'structuring'").limit(1)
    keys = set(a.first()["evidence_keys"])
    found = pipeline.run_lineage(world.tables, a).collect()
    assert {r["entity_key"] for r in found} == keys and all(r["kafka_offset"] is not None for r in found)


def test_outbox_queue_and_service(world):
    assert world.publish() == world.n_alerts
    assert world.publish() == 0
    store = AlertStore(world.tables)
    counts = world.consume(store, "q1")
    assert counts == {"stored": world.n_alerts, "duplicate": 0, "rejected": 0}
    again = world.consume(store, "q2")
    assert again == {"stored": 0, "duplicate": world.n_alerts, "rejected": 0}
    status, page = answer(store, "GET", "/alerts?limit=2")
    assert status == 200 and len(page) == 2
    one = page[0]["alert_id"]
    assert answer(store, "PATCH", f"/alerts/{one}", b'{"status": "CONFIRMED", "note": "seen"}')[1]["decided_at"]
    assert answer(store, "PATCH", f"/alerts/{one}", b'{"status": "OPEN"}')[1]["decided_at"] is None
    assert answer(store, "PATCH", f"/alerts/{one}", b'{"status": "LATER"}')[0] == 422
    assert answer(store, "GET", "/alerts/none")[0] == 404 and answer(store, "GET", "/alerts?limit=0")[0] == 422
    assert answer(store, "GET", "/stats")[1]["total"] == world.n_alerts
    server = serve(store, port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    with urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}/alerts/{one}") as r:
        assert json.load(r)["alert_id"] == one
    server.shutdown()
    assert answer(store, "GET", "/health")[1] == {"status": "ok", "consumer_running": False, "alerts": world.n_alerts}


def test_a_failure_before_the_watermark_replays_the_same_ids(world, monkeypatch):
    world.bank.hour()
    monkeypatch.setattr(world.tables, "upsert", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        world.capture()
    monkeypatch.undo()
    world.capture()
    world.load()
    b = world.tables.read("bronze_change_events")
    assert b.count() == b.select("event_id").distinct().count()
    live = {r["tx_id"] for r in world.view("silver_card_transactions").where("not _is_deleted").collect()}
    assert live == world.bank.tables["card_transactions"].keys()
