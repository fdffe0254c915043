"""Column expressions for the identity of rows and changes: canonical JSON, event ids, hashes, keys. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, DecimalType, StructType, TimestampNTZType, TimestampType

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def wire(column: Column, kind) -> Column:
    """A value as it stands in JSON: exact numbers and times as text, bytes as 0x…, the rest as they are."""
    if isinstance(kind, DecimalType):
        return column.cast("string")
    if isinstance(kind, DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(kind, TimestampType | TimestampNTZType):
        return F.date_format(column.cast("timestamp"), ISO_MICROS)
    if isinstance(kind, BinaryType):
        return F.concat(F.lit("0x"), F.lower(F.hex(column)))
    return column


def row_json(schema: StructType, columns: list[str], prefix: str = "", ordered: bool = True) -> Column:
    """The columns as one JSON object with sorted names; nulls are kept."""
    names = sorted(columns) if ordered else columns
    parts = [wire(F.col(f"{prefix}`{c}`"), schema[c].dataType).alias(c) for c in names]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def event_id(system: Column, table: Column, key_json: Column, position: Column) -> Column:
    """Depends on what changed and where in the source, not on when it was captured."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (system, table, key_json, position)]), 256)


def payload_hash(before: Column, after: Column) -> Column:
    return F.sha2(F.concat(F.lit("["), F.coalesce(before, F.lit("null")), F.lit(","), F.coalesce(after, F.lit("null")), F.lit("]")), 256)


def fingerprint(json_text: Column) -> Column:
    """The first 16 hexadecimal digits of a row's hash."""
    return F.substring(F.sha2(json_text, 256), 1, 16)


def topic_key(table: Column, names: list[str], prefix: str = "") -> Column:
    """<table>:<name=value,…>, names sorted."""
    pairs = [F.concat(F.lit(f"{n}="), F.coalesce(F.col(f"{prefix}`{n}`").cast("string"), F.lit("None"))) for n in sorted(names)]
    return F.concat(table, F.lit(":"), F.concat_ws(",", *pairs))


def alert_id(rule: Column, account: Column, evidence: Column) -> Column:
    """Stable across reruns: rule, account and the first evidence key."""
    return F.sha2(F.concat_ws("|", rule, account.cast("string"), F.element_at(evidence, 1)), 256)
