"""Alert rules over event tables.

Both rules look a bounded time back and ahead, so a key's events are cut into time slabs with a halo, and windows are
partitioned by (key, slab): a key that holds a third of all events is spread over as many tasks as its time span has
slabs. No rule joins the table with itself.

With `touched` (account_id, ts: where rows changed) a rule looks only at slabs that these moments can reach, and gives the alerts in
them as it would over all events: each run costs what is new, but for a scan that Spark may cut with a filter of the touched slabs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.identity import alert_id

#: Slab length in units of the rule's window.
SLAB = 64
# Seconds that the bank's rules look at.
VELOCITY_S, TRAVEL_S, STRUCTURING_S = 600, 3600, 86_400


def seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp"))


def _slabs(s: Column, length: int, back: int, ahead: int) -> Column:
    """The slabs a moment belongs to: its own first, then those whose halo it is in."""
    own = F.floor(s / length).cast("long")
    return F.array_compact(F.array(own, F.when(s >= (own + 1) * length - back, own + 1), F.when(s < own * length + ahead, own - 1)))


def _dealt(df: DataFrame, window_s: int, back: int, ahead: int) -> DataFrame:
    length = max(1, SLAB * window_s)
    return df.withColumn("__slab", F.explode(_slabs(F.col("__s"), length, back, ahead))).withColumn("__own", F.col("__slab") == F.floor(F.col("__s") / length).cast("long"))


def _reached(dealt: DataFrame, touched: DataFrame | None, window_s: int, back: int, ahead: int, beside: int) -> DataFrame:
    """The rows of the slabs that touched moments reach (`__hit`) and of so many slabs on either side of them."""
    if touched is None:
        return dealt.withColumn("__hit", F.lit(True))
    moments = touched.select(F.col("account_id").alias("__who"), seconds(F.col("ts")).alias("s")).where("__who is not null and s is not null")
    slabs = moments.select("__who", F.explode(_slabs(F.col("s"), max(1, SLAB * window_s), back, ahead)).alias("slab")).distinct()
    off = F.explode(F.sequence(F.lit(-beside), F.lit(beside))) if beside else F.lit(0)
    around = slabs.select("__who", "slab", off.alias("off")).groupBy("__who", (F.col("slab") + F.col("off")).alias("__at")).agg(F.max(F.col("off") == 0).alias("__hit"))
    return dealt.join(around, (F.col("account_id") == F.col("__who")) & (F.col("__slab") == F.col("__at"))).drop("__who", "__at")


def reach_of_bursts(window_s: int) -> int:
    """Seconds around a touched moment beyond which `bursts` looks at no row."""
    return (3 * SLAB + 2) * window_s


def reach_of_changes(max_gap_s: int) -> int:
    """The same of `changes_of`."""
    return (2 * SLAB + 2) * max_gap_s


def bursts(events: DataFrame, key: str, item: str, ts: str, min_count: int, window_s: int, rule: str, commit: str | None = None, touched: DataFrame | None = None) -> DataFrame:
    """One row for each burst: at least min_count events of a key within window_s seconds (both ends included).

    A burst starts at an event that has enough events in the window from it on, if no such event lies in the window_s seconds
    before; its evidence is every event from the start to window_s after. Rows without key or time are ignored.
    rule, account_id, evidence_keys (sorted as text), first_evidence_ts, last_source_commit_ts.
    """
    base = events.select(F.col(key).alias("account_id"), F.col(item).cast("string").alias("item"), F.col(ts).cast("timestamp").alias("ts"), (F.col(commit) if commit else F.col(ts)).cast("timestamp").alias("commit"), seconds(F.col(ts)).alias("__s"))
    dealt = _dealt(base.where("account_id is not null and __s is not null"), window_s, 2 * window_s, window_s)
    # a burst that a touched slab has part of may begin or end in the next one
    dealt = _reached(dealt, touched, window_s, 2 * window_s, window_s, 1)
    w = Window.partitionBy("account_id", "__slab").orderBy("__s")
    n = F.count("*").over(w.rangeBetween(0, window_s))
    dealt = dealt.withColumn("__q", F.when(n >= min_count, F.col("__s")))
    before = F.max("__q").over(w.rangeBetween(-window_s, -1))
    dealt = dealt.withColumn("__start", F.when(before.isNull(), F.col("__q")))
    dealt = dealt.withColumn("__burst", F.max("__start").over(w.rangeBetween(-window_s, 0)))
    found = dealt.where("__own and __burst is not null").groupBy("account_id", "__burst")
    out = found.agg(F.array_sort(F.collect_list("item")).alias("evidence_keys"), F.min("ts").alias("first_evidence_ts"), F.max("commit").alias("last_source_commit_ts"), F.max("__hit").alias("__hit")).where("__hit")
    return out.select(F.lit(rule).alias("rule"), "account_id", "evidence_keys", "first_evidence_ts", "last_source_commit_ts")


def changes_of(events: DataFrame, key: str, item: str, ts: str, attribute: str, max_gap_s: int, rule: str, commit: str | None = None, touched: DataFrame | None = None) -> DataFrame:
    """One row for each two consecutive events (by time, item) of a key at most max_gap_s apart whose attribute differs."""
    base = events.select(F.col(key).alias("account_id"), F.col(item).alias("item"), F.col(ts).cast("timestamp").alias("ts"), F.col(attribute).alias("value"), (F.col(commit) if commit else F.col(ts)).cast("timestamp").alias("commit"), seconds(F.col(ts)).alias("__s"))
    dealt = _dealt(base.where("account_id is not null and __s is not null"), max_gap_s, max_gap_s + 1, 0)
    dealt = _reached(dealt, touched, max_gap_s, max_gap_s + 1, 0, 0)
    w = Window.partitionBy("account_id", "__slab").orderBy("ts", "item")
    prev = F.lag(F.struct("item", "ts", "value", "commit", "__s")).over(w)
    j = dealt.withColumn("__prev", prev).where("__own and __prev.value is not null and value <> __prev.value").where(F.col("__s") - F.col("__prev.__s") <= max_gap_s)
    return j.select(
        F.lit(rule).alias("rule"),
        "account_id",
        F.array(F.col("__prev.item").cast("string"), F.col("item").cast("string")).alias("evidence_keys"),
        F.col("__prev.ts").alias("first_evidence_ts"),
        F.greatest("__prev.commit", "commit").alias("last_source_commit_ts"),
    )


def in_band(df: DataFrame, column: str, low, high) -> DataFrame:
    """low <= column < high"""
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def union_rules(*alerts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), alerts)


def as_alerts(found: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Adds id, creation time, latency in seconds and the empty outbox flag."""
    made = F.current_timestamp() if created_at is None else created_at
    out = found.withColumn("alert_id", alert_id(F.col("rule"), F.col("account_id"), F.col("evidence_keys"))).withColumn("alert_created_at", made)
    latency = (F.unix_micros("alert_created_at") - F.unix_micros("last_source_commit_ts")) / 1e6
    return out.select("alert_id", "rule", F.col("account_id").cast("int").alias("account_id"), "evidence_keys", "first_evidence_ts", "last_source_commit_ts", "alert_created_at", latency.alias("latency_seconds"), F.lit(None).cast("timestamp").alias("published_at"))


def card_velocity(cards: DataFrame, min_count: int = 5, window_s: int = VELOCITY_S, touched: DataFrame | None = None) -> DataFrame:
    """Deleted transactions count: an expired authorisation was an attempt."""
    return bursts(cards, "account_id", "tx_id", "tx_ts", min_count, window_s, "card_velocity", "_first_commit_ts", touched)


def impossible_travel(cards: DataFrame, max_gap_s: int = TRAVEL_S, touched: DataFrame | None = None) -> DataFrame:
    return changes_of(cards, "account_id", "tx_id", "tx_ts", "country", max_gap_s, "impossible_travel", "_first_commit_ts", touched)


def owned(transfers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transfers and the account they go out from; accounts deleted at the source still own their transfers."""
    return transfers.join(accounts.select("iban", "account_id"), transfers["debtor_iban"] == accounts["iban"]).select(*[transfers[c] for c in transfers.columns], "account_id")


def structuring(transfers: DataFrame, accounts: DataFrame, low: int = 9000, high: int = 10000, min_count: int = 3, window_s: int = STRUCTURING_S, touched: DataFrame | None = None) -> DataFrame:
    """Live outgoing transfers within the band."""
    live = in_band(transfers.where("not _is_deleted"), "amount", low, high)
    return bursts(owned(live, accounts), "account_id", "transfer_id", "booking_ts", min_count, window_s, "structuring", "_first_commit_ts", touched)
