"""Query-based capture: tables with a change timestamp, polled from a watermark on and compared with a snapshot now and then.

The watermark is inclusive, as rows may share a timestamp and some may have come late; the keys already given at it are
left out by an anti-join. What is known of every row (key and fingerprint) is a table of its own, not part of
the watermark, so its size is no limit. Rows younger than the safety lag wait for the next run.

A snapshot finds deletes and missed changes by one full outer join on the key, of the rows in ranges whose digests differ. Deletes are sought among all rows of
the table, those within the safety lag included, so a row changed just now is never taken for deleted. A delete's
position names the version it ended (fingerprint and time), so replays agree and delete, re-insert, delete differ.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import identity
from tidemark.sources.base import Capture, Known, to_events
from tidemark.sources.range_digests import Ranges


def after_watermark(rows: DataFrame, ts: str, since: Column | None, until: Column, keys: list[str], given: DataFrame | None) -> DataFrame:
    """Rows with since <= ts < until, without those at `since` whose key was given then."""
    out = rows.where(F.col(ts) < until)
    if since is None:
        return out
    out = out.where(F.col(ts) >= since)
    if given is None:
        return out
    g = given.select(*[F.col(k).alias(f"__{k}") for k in keys])
    on = F.col(ts) == since
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return out.join(g, on, "left_anti")


def snapshot_changes(now: DataFrame, known: DataFrame, keys: list[str], deletes_from: DataFrame | None = None) -> DataFrame:
    """Rows of `now` that are new (c) or differ from `known` (u), and known keys that are gone (d). Both have `fingerprint`.

    deletes_from: the keys that exist, if more than those of `now` do.
    """
    k = known.select(*[F.col(x).alias(f"__{x}") for x in keys], F.col("fingerprint").alias("__fp"), *[F.col(c).alias(f"__known_{c}") for c in known.columns if c not in (*keys, "fingerprint")])
    on = None
    for x in keys:
        c = F.col(x) == F.col(f"__{x}")
        on = c if on is None else on & c
    j = now.join(k, on, "full_outer").where(~F.col("fingerprint").eqNullSafe(F.col("__fp")))
    op = F.when(F.col("__fp").isNull(), "c").when(F.col("fingerprint").isNull(), "d").otherwise("u")
    rest = [c for c in now.columns if c not in (*keys, "fingerprint")]
    out = j.select(*[F.coalesce(F.col(x), F.col(f"__{x}")).alias(x) for x in keys], *rest, F.coalesce("fingerprint", "__fp").alias("fingerprint"), op.alias("op"), *[c for c in j.columns if c.startswith("__known_")])
    if deletes_from is None:
        return out
    there = deletes_from.select(*keys).distinct().withColumn("__there", F.lit(True))
    return out.join(there, keys, "left").where("op <> 'd' or __there is null").drop("__there")


def snapshot_due(state: dict[str, Any], every: int) -> tuple[bool, int]:
    """Whether this run takes a snapshot (the first one does), and the counter to keep."""
    runs = state.get("runs_since_snapshot", every)
    return (True, 0) if runs + 1 >= every else (False, runs + 1)


@dataclass
class VersionedRows:
    schema: str
    table: str
    primary_key: list[str]
    ts_column: str

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.table}"


class RowVersionSource:
    """read(table) gives its rows now; known(table) what earlier runs kept (keys, fingerprint, ts text), or None; clock() the source's time."""

    system = "db2"

    def __init__(self, name: str, database: str, tables: list[VersionedRows], read: Callable[[str], DataFrame], clock: Callable[[], datetime], known: Callable[[str], DataFrame | None], snapshot_every: int = 3, safety_lag: timedelta = timedelta(seconds=2)):
        self.name, self.database, self.tables, self.read, self.clock, self.known = name, database, tables, read, clock, known
        self.snapshot_every, self.safety_lag = snapshot_every, safety_lag

    def capture(self, watermark: dict[str, Any] | None, trace_id: str) -> Capture:
        before = watermark or {}
        due, runs = snapshot_due(before, self.snapshot_every)
        now = self.clock()
        upper = F.lit((now - self.safety_lag).isoformat()).cast("timestamp")
        marks, kept, events = dict(before.get("tables", {})), {}, None
        for t in self.tables:
            part, mark, known = self._table(t, marks.get(t.qualified), upper, now, due, trace_id)
            events = part if events is None else events.unionByName(part)
            if mark:
                marks[t.qualified] = mark
            kept[t.qualified] = known
        return Capture(events, {"tables": marks, "runs_since_snapshot": runs}, known=kept)

    def _prepared(self, t: VersionedRows) -> DataFrame:
        df = self.read(t.qualified)
        data = [c for c in df.columns if c != t.ts_column]
        ts = F.col(t.ts_column).cast("timestamp")
        image = identity.row_json(df.schema, data)
        return df.select(*t.primary_key, ts.alias("__ts"), image.alias("__json"), identity.fingerprint(image).alias("fingerprint"), F.date_format(ts, identity.ISO_MICROS).alias("__iso"))

    def _table(self, t: VersionedRows, mark: dict | None, upper: Column, now: datetime, due: bool, trace_id: str):
        spark_rows = self._prepared(t)
        spark = spark_rows.sparkSession
        keys = t.primary_key
        known = self.known(t.qualified)
        if known is None:
            known = spark.createDataFrame([], spark_rows.select(*keys, "fingerprint", F.col("__iso").alias("ts")).schema)
        since = F.lit(mark["ts"]).cast("timestamp") if mark else None
        given = None
        if mark:  # what was given at the watermark is what is known with its time
            given = known.where(F.col("ts") == mark["ts"])
        polled = after_watermark(spark_rows, "__ts", since, upper, keys, given)
        seen = known.select(*keys).withColumn("__seen", F.lit(True))
        polled = polled.join(seen, keys, "left").withColumn("op", F.when(F.col("__seen"), "u").otherwise("c")).drop("__seen")
        changes = polled.select(*keys, "op", "__json", "__iso", "fingerprint", F.col("__iso").alias("__seq"), F.concat(F.lit(f"{t.ts_column}="), F.col("__iso")).alias("__pos"), F.col("__iso").alias("__commit"))
        news = polled.select(*keys, "fingerprint", F.col("__iso").alias("ts"))
        updated = _newest(known, news, keys)
        if due:
            settled = spark_rows.where(F.col("__ts") < upper)
            # what was polled differs from what is known too: ranges without a difference need no join
            differ = Ranges(settled, known, keys)
            diff = snapshot_changes(differ.of(settled), _newest(differ.of(known), differ.of(news), keys), keys, deletes_from=differ.of(spark_rows))
            scan = now.strftime("%Y-%m-%dT%H:%M:%S.%f")
            gone = F.col("op") == "d"
            changes = changes.unionByName(
                diff.select(
                    *keys,
                    "op",
                    F.when(~gone, F.col("__json")).alias("__json"),
                    "__iso",
                    "fingerprint",
                    F.when(gone, F.lit(f"{scan}|snapshot")).otherwise(F.col("__iso")).alias("__seq"),
                    F.when(gone, F.concat(F.lit("deleted-after:"), F.col("fingerprint"), F.lit("@"), F.col("__known_ts"))).otherwise(F.concat(F.lit(f"{t.ts_column}="), F.col("__iso"))).alias("__pos"),
                    F.when(gone, F.lit(now.isoformat())).otherwise(F.col("__iso")).alias("__commit"),
                )
            )
            there = spark_rows.select(*keys)
            kept = updated.join(there, keys, "left_semi")
            updated = _newest(kept, settled.select(*keys, "fingerprint", F.col("__iso").alias("ts")), keys)
        top = polled.agg(F.max("__iso")).first()[0]
        newest = max(filter(None, [top, mark["ts"] if mark else None]), default=None)
        null = F.lit(None).cast("string")
        key_json = identity.row_json(spark_rows.schema, keys)
        events = to_events(changes, self.system, self.database, t.qualified, keys, key_json, F.col("op"), null, F.when(F.col("op") != "d", F.col("__json")), F.col("__pos"), F.col("__commit"), F.col("__seq"), trace_id)
        return events, ({"ts": newest} if newest else None), (Known(updated, keys) if due else Known(updated, keys, news, lambda old, new: new if old is None else _newest(old, new, keys)))

    def stats(self) -> dict[str, dict[str, Any]]:
        return {t.qualified: {"rows": self.read(t.qualified).count()} for t in self.tables}


def _newest(known: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """Known rows with those of `more`, the later time winning."""
    both = known.unionByName(more)
    best = both.groupBy(*keys).agg(F.max(F.struct("ts", "fingerprint")).alias("b"))
    return best.select(*keys, F.col("b.fingerprint").alias("fingerprint"), F.col("b.ts").alias("ts"))
