"""The analyst queue: a store of alerts with their decisions, and a small HTTP face of it."""

from __future__ import annotations

import json
import re
import threading
from datetime import UTC, datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import Any
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.streaming.topic_log import with_offsets
from tidemark.tables import Tables

# Fixed values.
STATUSES = ("OPEN", "CONFIRMED", "DISMISSED")
ANALYST = ("status", "note", "decided_at", "received_at")


class AlertStore:
    """Alerts by id. A repeated alert refreshes its evidence only; what analysts wrote stays."""

    table = "alert_queue"

    def __init__(self, tables: Tables):
        self.tables, self._lock = tables, threading.Lock()

    def unknown(self, alerts: DataFrame) -> int:
        """How many alerts of a batch aren't stored yet."""
        ids = alerts.select("alert_id").distinct()
        have = lambda: self.tables.lookup(self.table, ids, ["alert_id"]).select("alert_id")
        return self.tables.stable(self.table, lambda: ids.join(have(), "alert_id", "left_anti").count())

    def upsert(self, alerts: DataFrame, count: bool = True) -> int | None:
        """Stores a batch and returns how many alerts are new, if asked. Of repeats within the batch, one counts."""
        now = datetime.now(UTC).isoformat()
        once = alerts.dropDuplicates(["alert_id"])
        given = [c for c in once.columns if c not in ANALYST]
        rows = once.select(*given, F.lit("OPEN").alias("status"), F.lit(None).cast("string").alias("note"), F.lit(None).cast("string").alias("decided_at"), F.lit(now).alias("received_at")).persist()
        try:
            with self._lock:
                new = self.unknown(rows) if count else None
                keep = [c for c in rows.columns if c not in ("alert_id", "evidence_keys")]
                self.tables.upsert(self.table, rows, ["alert_id"], keep)
        finally:
            rows.unpersist()
        return new

    def get(self, alert_id: str) -> dict[str, Any] | None:
        near = lambda: self.tables.lookup(self.table, self._id(alert_id), ["alert_id"])  # noqa: E731  the bucket it is in
        rows = self.tables.stable(self.table, lambda: near().where(F.col("alert_id") == alert_id).take(1))
        return rows[0].asDict() if rows else None

    def _id(self, alert_id: str) -> DataFrame:
        return self.tables.spark.range(0, 1, 1, 1).select(F.lit(alert_id).alias("alert_id"))

    def page(self, status: str | None = None, rule: str | None = None, account_id: int | None = None, limit: int = 100, offset: int = 0, after: tuple[str | None, str] | None = None) -> DataFrame:
        """Newest first; filters hold together. after: (alert_created_at, alert_id) of the last row of the page before; alerts that come meanwhile then neither
        repeat a row nor hide one, and no row before it is sorted."""
        df = self._filtered(status, rule, account_id)
        if after is not None:
            at, alert_id = F.lit(after[0]).cast("string"), F.lit(after[1])
            time = F.col("alert_created_at")
            df = df.where((time < at) | (time.isNull() & at.isNotNull()) | (time.eqNullSafe(at) & (F.col("alert_id") > alert_id)))
        return df.orderBy(*self._order()).offset(offset).limit(limit)

    def _filtered(self, status: str | None, rule: str | None, account_id: int | None) -> DataFrame:
        df = self.tables.read(self.table)
        for column, value in (("status", status), ("rule", rule), ("account_id", account_id)):
            if value is not None:
                df = df.where(F.col(column) == value)
        return df

    @staticmethod
    def _order() -> list[Column]:
        return [F.col("alert_created_at").desc(), F.col("alert_id").asc()]

    def walk(self, size: int, status: str | None = None, rule: str | None = None, account_id: int | None = None) -> DataFrame:
        """All alerts, each with the number of its page (`page`, from 0) if pages of `size` go on behind each other's last row. The queue is scanned and dealt by
        ranges of that order once, however many pages there are; `page` scans it for each."""
        rows = self._filtered(status, rule, account_id).withColumn("__queue", F.lit(0))
        placed = with_offsets(rows, "__queue", self._order(), "__place", {})
        return placed.select(F.floor(F.col("__place") / size).cast("int").alias("page"), *[c for c in rows.columns if c != "__queue"])

    def list(self, *args, **options) -> list[dict[str, Any]]:
        return [r.asDict() for r in self.page(*args, **options).collect()]

    def set_status(self, alert_id: str, status: str, note: str | None = None) -> dict[str, Any] | None:
        """Records a decision (an alert opened again has none); None for an unknown id."""
        if status not in STATUSES:
            raise ValueError(f"status is one of {', '.join(STATUSES)}")
        with self._lock:
            found = self.get(alert_id)
            if found is None:
                return None
            put = {"status": status, "note": note, "decided_at": None if status == "OPEN" else datetime.now(UTC).isoformat()}
            this = F.col("alert_id") == alert_id
            decided = lambda old, _: old.withColumns({c: F.when(this, F.lit(v).cast("string")).otherwise(F.col(c)) for c, v in put.items()})
            self.tables.merge(self.table, self._id(alert_id), ["alert_id"], decided)
        return found | put

    def stats(self) -> dict[str, Any]:
        counts = self.tables.read(self.table).groupBy("status", "rule").count().collect()
        by = lambda k: {v: sum(r["count"] for r in counts if r[k] == v) for v in sorted({r[k] for r in counts})}
        return {"total": sum(r["count"] for r in counts), "by_status": by("status"), "by_rule": by("rule")}


class BadRequest(ValueError):
    """Answered with 422."""


def _whole(query: dict[str, list[str]], name: str, default: int | None, low: int | None = None, high: int | None = None) -> int | None:
    if name not in query:
        return default
    try:
        n = int(query[name][0])
    except ValueError:
        raise BadRequest(f"{name} is a whole number") from None
    if (low is not None and n < low) or (high is not None and n > high):
        raise BadRequest(f"{name} is out of range")
    return n


def _after(store: AlertStore, query: dict[str, list[str]]) -> tuple[str | None, str] | None:
    """The place of the alert that a page goes on behind."""
    if "after" not in query:
        return None
    found = store.get(query["after"][0])
    if found is None:
        raise BadRequest("after is the id of an alert")
    return found["alert_created_at"], found["alert_id"]


def answer(store: AlertStore, method: str, target: str, body: bytes = b"", counts: dict | None = None, running: bool = False) -> tuple[int, Any]:
    """Status and JSON value for a request. GET /health /alerts /alerts/{id} /stats, PATCH /alerts/{id}."""
    url = urlsplit(target)
    q = parse_qs(url.query)
    one = re.fullmatch(r"/alerts/([^/]+)", url.path)
    try:
        if method == "GET" and url.path == "/health":
            return 200, {"status": "ok", "consumer_running": running, "alerts": store.stats()["total"]}
        if method == "GET" and url.path == "/stats":
            return 200, store.stats() | ({"consumer": counts} if counts is not None else {})
        if method == "GET" and url.path == "/alerts":
            status = q.get("status", [None])[0]
            if status is not None and status not in STATUSES:
                raise BadRequest("unknown status")
            return 200, store.list(status, q.get("rule", [None])[0], _whole(q, "account_id", None), _whole(q, "limit", 100, 1, 1000), _whole(q, "offset", 0, 0), _after(store, q))
        if one and method == "GET":
            found = store.get(one[1])
        elif one and method == "PATCH":
            try:
                decision = json.loads(body or b"null")
            except ValueError:
                raise BadRequest("the body is not JSON") from None
            if not isinstance(decision, dict) or decision.get("status") not in STATUSES:
                raise BadRequest("unknown status")
            found = store.set_status(one[1], decision["status"], decision.get("note"))
        else:
            return 404, {"detail": "not found"}
        return (404, {"detail": "alert not found"}) if found is None else (200, found)
    except BadRequest as e:
        return 422, {"detail": str(e)}


def serve(store: AlertStore, host: str = "127.0.0.1", port: int = 8080) -> ThreadingHTTPServer:
    """A server ready for serve_forever()."""

    class Handler(BaseHTTPRequestHandler):
        def _do(self) -> None:
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            status, value = answer(store, self.command, self.path, body)
            data = json.dumps(value).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_PATCH = _do

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
