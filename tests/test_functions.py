import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import checks, identity
from tidemark.types import EVENT, schema


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} STRING" for k in values)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("iban", "valid"),
    [("PT50003300000000000000191", None), ("GB82WEST12345698765432", True), ("DE89370400440532013000", True), ("DE88370400440532013000", False), ("gb82west12345698765432", True), ("GB82", False), ("1282WEST12345698765432", False), ("GB82 WEST 1234 5698 7654 32", False), ("", False), (None, False)],
)
def test_iban(spark, iban, valid):
    if valid is None:
        n = int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4]))
        valid = n % 97 == 1
    assert one(spark, checks.iban_valid(F.col("v")), v=iban) is valid


@pytest.mark.parametrize(
    ("raw", "value"),
    [("12.50", "12.50"), (" 12.5 ", "12.50"), ("+3", "3.00"), ("1e2", "100.00"), ("1.5e1", "15.00"), ("0", None), ("-1", None), ("1.234", None), ("1.250,00", None), ("abc", None), ("NaN", None), ("Infinity", None), ("", None), (None, None), ("1.000", None)],
)
def test_amount(spark, raw, value):
    got = one(spark, checks.amount(F.col("v")), v=raw)
    assert (None if got is None else str(got)) == value


def test_first_fault_of_a_transfer_wins(spark):
    good = {"transfer_id": "T1", "debtor_iban": "GB82WEST12345698765432", "creditor_iban": "DE89370400440532013000", "amount": "10.00", "booking_ts": "2026-10-01T09:00:00"}
    fault = lambda **k: one(spark, checks.transfer_fault(), **(good | k))
    assert fault() is None
    assert fault(amount="") == "missing amount"
    assert fault(amount="x", debtor_iban="y") == "invalid amount"
    assert fault(debtor_iban="GB82WEST12345698765433") == "invalid debtor_iban"
    assert fault(creditor_iban="nope", debtor_iban=good["debtor_iban"]) == "invalid creditor_iban"


def event(**changes):
    sha = hashlib.sha256(b"x").hexdigest()
    e = {"event_id": sha, "op": "c", "key": {"id": 1}, "before": None, "after": {"id": 1}, "source": {"system": "s", "database": "d", "table": "t", "position": "1", "commit_ts": None, "sequence": None}, "captured_at": "2026-10-01T09:00:00", "trace_id": "t", "schema_version": 1, "payload_hash": sha}
    return json.dumps(e | changes)


@pytest.mark.parametrize(
    ("text", "n"),
    [
        (event(), 0),
        (event(op="u", before={"id": 1}), 0),
        (event(op="d", before={"id": 1}, after=None), 0),
        (event(op="x"), 1),
        (event(key={}), 1),
        (event(after=None), 1),
        (event(op="d"), 2),
        (event(op="d", after=None, source={"system": "db2", "database": "d", "table": "t", "position": "1"}), 0),
        (event(event_id="abc"), 1),
        (event(schema_version=2), 1),
        (event(source={"system": "s", "database": "d", "table": "t"}), 1),
    ],
)
def test_event_contract(spark, text, n):
    df = spark.createDataFrame([(text,)], "v STRING").select(F.from_json("v", EVENT).alias("e")).select(checks.event_faults("e").alias("f"))
    assert len(df.first()["f"]) == n


@pytest.mark.parametrize("odd", ["a}b", '"', "{", "\\", "a\nb", "", "é}日", None])
def test_event_messages_are_json_whatever_a_field_holds(spark, odd):
    from tidemark.sources.base import event_json

    names = [f.name for f in schema(EVENT)]
    source = {n: odd for n in schema(EVENT)["source"].dataType.names}
    row = {n: odd for n in names} | {"key": '{"id":1}', "before": None, "after": '{"v":"}"}', "source": source, "schema_version": 1}
    text = spark.createDataFrame([tuple(row[n] if n != "source" else tuple(source.values()) for n in names)], EVENT).select(event_json().alias("m")).first()["m"]
    got = json.loads(text)
    assert got == row | {"key": {"id": 1}, "after": {"v": "}"}} and list(got) == sorted(names)


def test_an_event_of_nulls_is_json(spark):
    from tidemark.sources.base import event_json

    text = spark.createDataFrame([tuple(None for _ in schema(EVENT))], EVENT).select(event_json().alias("m")).first()["m"]
    assert set(json.loads(text).values()) == {None}


def test_unreadable_event_has_faults_and_no_id(spark):
    df = spark.createDataFrame([("not json",)], "v STRING").select(F.from_json("v", EVENT).alias("e"))
    assert df.select(checks.event_faults("e").alias("f")).first()["f"]


def test_ids_depend_on_the_change_only(spark):
    df = spark.createDataFrame([(1, "a", "0x01:0x02")], "id INT, name STRING, pos STRING")
    key = identity.row_json(df.schema, ["id"])
    a, b = df.select(identity.event_id(F.lit("s"), F.lit("t"), key, F.col("pos")).alias("a"), identity.event_id(F.lit("s"), F.lit("t"), key, F.lit("0x01:0x03")).alias("b")).first()
    assert a == hashlib.sha256(b's|t|{"id":1}|0x01:0x02').hexdigest() and a != b


def test_payload_hash_covers_both_images(spark):
    null = F.lit(None).cast("string")
    r = spark.range(1).select(identity.payload_hash(null, F.lit("{}")).alias("a"), identity.payload_hash(F.lit("{}"), null).alias("b")).first()
    assert r["a"] == hashlib.sha256(b"[null,{}]").hexdigest() and r["a"] != r["b"]


def test_wire_values(spark):
    df = spark.sql("select cast('80.50' as decimal(18,2)) m, date'2026-01-02' d, timestamp'2026-01-02 03:04:05.6' t, x'00ff' b, cast(null as string) n, 7 i")
    got = json.loads(df.select(identity.row_json(df.schema, df.columns).alias("j")).first()["j"])
    assert got == {"m": "80.50", "d": "2026-01-02", "t": "2026-01-02T03:04:05.600000", "b": "0x00ff", "n": None, "i": 7}
    back = spark.createDataFrame([(json.dumps(got),)], "j STRING").select(F.from_json("j", "m DECIMAL(18,2), d DATE, t TIMESTAMP, i INT").alias("r")).first()["r"]
    assert str(back["m"]) == "80.50" and back["i"] == 7 and back["t"].microsecond == 600000


def test_topic_key_sorts_names(spark):
    assert spark.sql("select 2 b, 1 a").select(identity.topic_key(F.lit("t"), ["b", "a"])).first()[0] == "t:a=1,b=2"


def test_fingerprint_is_sixteen_digits(spark):
    assert spark.range(1).select(identity.fingerprint(F.lit("x"))).first()[0] == hashlib.sha256(b"x").hexdigest()[:16]


def test_schemas_parse():
    from tidemark.types import QUEUE, STATE_META, TABLES

    assert all(schema(d).names for d in [*TABLES.values(), QUEUE, STATE_META, EVENT])
