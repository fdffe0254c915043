"""Log-based capture: change tables with a log position, a sequence within it and an operation code.

Codes: 1 delete, 2 insert, 3 row before an update, 4 row after it. A table gives its rows with columns `lsn` and `seq`
(BINARY of fixed width, which sorts like its hexadecimal text), `code`, `commit_ts`, and the row's own columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import identity
from tidemark.sources.base import Capture, to_events


class GapError(RuntimeError):
    """Changes after the watermark are no longer retained: take a new snapshot."""


def op_of(code: Column) -> Column:
    """The op of an operation code; an unknown one stops the query. Code 3 has none: it belongs to code 4."""
    return F.when(code == 1, "d").when(code == 2, "c").when(code == 4, "u").when(code == 3, F.lit(None).cast("string")).otherwise(F.raise_error(F.concat(F.lit("unexpected operation code "), code.cast("string"))))


def paired(rows: DataFrame, lsn: str, seq: str, code: str, image: str) -> DataFrame:
    """lsn, seq, op, before, after and other columns: the two rows of an update as one change, by one aggregation."""
    c = F.col(code)
    checked = rows.withColumn("__op", op_of(c))
    rest = [x for x in rows.columns if x not in (lsn, seq, code, image)]
    pick = lambda cond: F.first(F.when(cond, F.col(image)), ignorenulls=True)
    single = F.when(c.isin(1, 2), c).otherwise(4)  # a delete and an insert may share a position with nothing else
    return (
        checked.groupBy(F.col(lsn), F.col(seq), single.alias("__kind"))
        .agg(F.max("__op").alias("op"), pick(c.isin(1, 3)).alias("before"), pick(c.isin(2, 4)).alias("after"), *[F.first(F.when(c != 3, F.col(x)), ignorenulls=True).alias(x) for x in rest])
        .where("op is not null")  # a before row alone is no change
        .drop("__kind")
    )


@dataclass
class LogTable:
    schema: str
    table: str
    primary_key: list[str]

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.table}"


class ChangeLogSource:
    """read(table) gives its change rows, rows(table) its current rows; max_lsn() the log's end, or None before the first capture."""

    system = "sqlserver"
    meta = ("lsn", "seq", "code", "commit_ts")

    def __init__(self, name: str, database: str, tables: list[LogTable], read: Callable[[str], DataFrame], max_lsn: Callable[[], bytes | None], min_lsn: Callable[[str], bytes], rows: Callable[[str], DataFrame] | None = None, sum_of: tuple[str, str] | None = ("dbo.accounts", "balance")):
        self.name, self.database, self.tables = name, database, tables
        self.read, self.max_lsn, self.min_lsn, self.rows, self.sum_of = read, max_lsn, min_lsn, rows, sum_of

    def capture(self, watermark: dict[str, Any] | None, trace_id: str) -> Capture:
        done = dict((watermark or {}).get("lsn", {}))
        top = self.max_lsn()
        if top is None:
            return Capture(None, {"lsn": done})
        events = None
        for t in self.tables:
            oldest = self.min_lsn(t.qualified)
            df = self.read(t.qualified)
            if t.qualified in done:
                last = bytes.fromhex(done[t.qualified][2:])
                if last < oldest:
                    raise GapError(f"{t.qualified}: the last position read, 0x{last.hex()}, is older than the oldest one kept, 0x{oldest.hex()}; take a new snapshot")
                df = df.where(F.col("lsn") > F.lit(bytearray(last)))
                if last >= top:
                    continue
            elif oldest > top:
                continue
            df = df.where(F.col("lsn") <= F.lit(bytearray(top)))  # the range reaches the scan
            part = self.events_of(df, t, trace_id)
            events = part if events is None else events.unionByName(part)
            done[t.qualified] = "0x" + top.hex()
        return Capture(events, {"lsn": done})

    def events_of(self, df: DataFrame, t: LogTable, trace_id: str) -> DataFrame:
        """Change events of a log table's rows, such as those of a micro-batch of log_stream."""
        data = [c for c in df.columns if c not in self.meta and not c.startswith("__")]
        rows = df.select("lsn", "seq", "code", "commit_ts", F.struct(identity.row_json(df.schema, data).alias("json"), F.struct(*t.primary_key).alias("key")).alias("image"))
        p = paired(rows, "lsn", "seq", "code", "image").withColumn("key", F.coalesce("after.key", "before.key"))
        position = F.concat(F.lit("0x"), F.lower(F.hex("lsn")), F.lit(":0x"), F.lower(F.hex("seq")))
        key_json = identity.row_json(df.schema, t.primary_key, "key.")
        null = F.lit(None).cast("string")
        before = F.when(F.col("op") != "c", F.col("before.json"))
        after = F.when(F.col("op") != "d", F.col("after.json"))
        commit = F.date_format(F.col("commit_ts").cast("timestamp"), identity.ISO_MICROS)
        return to_events(p, self.system, self.database, t.qualified, t.primary_key, key_json, F.col("op"), before, after, position, commit, null, trace_id, "key.")

    def stats(self) -> dict[str, dict[str, Any]]:
        out = {}
        for t in self.tables:
            df = self.rows(t.qualified)
            out[t.qualified] = {"rows": df.count()}
            if self.sum_of and self.sum_of[0] == t.qualified:
                out[t.qualified]["balance_sum"] = str(df.agg(F.sum(self.sum_of[1]).cast("string")).first()[0] or "0")
        return out
