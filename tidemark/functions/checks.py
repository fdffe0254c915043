"""Validity of values and events as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.types import OPS

# Fixed values.
REQUIRED_TRANSFER = ("transfer_id", "debtor_iban", "creditor_iban", "amount", "booking_ts")


def iban_valid(iban: Column) -> Column:
    """ISO 13616: at least 15 letters and digits, two letters first, remainder 1 modulo 97. Null is not valid.

    The number is never built: each character shifts the remainder by one digit, or two for a letter.
    """
    plain = F.coalesce(iban, F.lit(""))
    turned = F.upper(F.concat(F.substring(plain, 5, 1 << 20), F.substring(plain, 1, 4)))
    code = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda acc, c: (acc * F.when(c.between("0", "9"), 10).otherwise(100) + code(c)) % 97
    remainder = F.aggregate(F.split(turned, ""), F.lit(0), step)
    shape = plain.rlike("^[A-Za-z]{2}[A-Za-z0-9]{13,}$")
    return F.when(shape, remainder == 1).otherwise(False)


def amount(raw: Column) -> Column:
    """The amount as DECIMAL(18,2), or null unless it is a plain or exponent number, above 0, with two decimals at most."""
    text = F.trim(raw)
    number = text.rlike(r"^[+]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$")
    wide = F.when(number, text).try_cast("decimal(38,18)")
    cents = wide.try_cast("decimal(18,2)")
    # a number written with more than two decimals is refused even if they are zeros
    decimals = F.length(F.regexp_extract(text, r"\.(\d*)", 1)) - F.coalesce(F.regexp_extract(text, r"[eE]([+-]?\d+)$", 1).try_cast("int"), F.lit(0))
    return F.when((wide > 0) & (wide == cents) & (decimals <= 2), cents)


def transfer_fault(prefix: str = "") -> Column:
    """Why a partner transfer is refused (the first reason that holds), or null."""
    c = lambda n: F.col(f"{prefix}{n}")
    reasons = [F.when(F.coalesce(c(n), F.lit("")) == "", F.lit(f"missing {n}")) for n in REQUIRED_TRANSFER]
    reasons.append(F.when(amount(c("amount")).isNull(), F.lit("invalid amount")))
    reasons += [F.when(~iban_valid(c(n)), F.lit(f"invalid {n}")) for n in ("debtor_iban", "creditor_iban")]
    return F.coalesce(*reasons)


def event_faults(e: str = "e") -> Column:
    """What a parsed change event lacks, as an array of texts (empty: nothing). Deletes of query-based sources have no image."""
    f = lambda n: F.col(f"{e}.{n}")
    hexed = lambda n: ~F.coalesce(f(n).rlike("^[0-9a-f]{64}$"), F.lit(False))
    is_object = lambda n: F.coalesce(f(n).startswith("{") & f(n).endswith("}"), F.lit(False))
    query_based = F.col(f"{e}.source.system") == "db2"
    checks = [
        (hexed("event_id"), "event_id is not a sha256"),
        (hexed("payload_hash"), "payload_hash is not a sha256"),
        (~F.coalesce(f("op").isin(*OPS), F.lit(False)), "unknown op"),
        (~is_object("key") | (f("key") == "{}"), "key is empty"),
        (F.coalesce(f("schema_version"), F.lit(0)) != 1, "schema_version is not 1"),
        *[(F.col(f"{e}.source.{n}").isNull(), f"source.{n} is missing") for n in ("system", "database", "table", "position")],
        (f("captured_at").isNull(), "captured_at is missing"),
        (f("trace_id").isNull(), "trace_id is missing"),
        ((f("op") == "c") & ~is_object("after"), "a create needs an after image"),
        ((f("op") == "d") & f("after").isNotNull(), "a delete has no after image"),
        ((f("op") == "d") & ~is_object("before") & ~F.coalesce(query_based, F.lit(False)), "a delete needs a before image"),
    ]
    return F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(text)) for bad, text in checks]), lambda x: x.isNotNull())
