"""Rule cases of the transaction contract, one row each (text input, as staged JSON
values arrive), plus typed-input cases and the account / category contracts."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import rules as R
from ledgerline.functions.temporal import parse_iso
from ledgerline.operators import validate as V
from ledgerline.operators.rules import key_id

UUID = "123e4567-e89b-12d3-a456-426614174000"
GOOD = {
    "transaction_id": "1",
    "account_id": UUID,
    "category_id": "5",
    "amount": "100.00",
    "currency": "USD",
    "transaction_type": "debit",
    "status": "pending",
    "description": "x",
    "created_at": "2024-01-01T10:00:00",
    "updated_at": "2024-01-01T10:00:00",
}
COLS = list(GOOD)


def evaluate_one(spark, **changes):
    row = {**GOOD, **changes}
    df = spark.createDataFrame([tuple(row[c] for c in COLS)], ", ".join(f"{c} string" for c in COLS))
    r = R.evaluate(df, R.TRANSACTION_CONTRACT).first()
    return r


def outcome(r):
    if r["fatal"]:
        return "F"
    return "D" if r["errors"] else "ok"


CASES = [
    ("transaction_id", "1", "ok"), ("transaction_id", "0", "D"), ("transaction_id", "-1", "D"),
    ("transaction_id", None, "F"), ("transaction_id", "x", "F"), ("transaction_id", "5.5", "F"), ("transaction_id", "5.0", "F"),
    ("account_id", UUID, "ok"), ("account_id", "{" + UUID + "}", "ok"), ("account_id", "urn:uuid:" + UUID, "ok"),
    ("account_id", UUID.replace("-", ""), "ok"), ("account_id", UUID.upper(), "ok"),
    ("account_id", "x", "F"), ("account_id", " " + UUID, "F"), ("account_id", None, "D"),
    ("category_id", "5", "ok"), ("category_id", " 5 ", "ok"), ("category_id", "5.0", "ok"),
    ("category_id", "0", "D"), ("category_id", "5.5", "D"), ("category_id", None, "D"),
    ("amount", "100", "ok"), ("amount", "100.000", "ok"), ("amount", "100.500", "ok"), ("amount", "-5.25", "ok"),
    ("amount", "1E+3", "ok"), ("amount", "1.005", "D"), ("amount", "1.0050", "D"), ("amount", "9999999999999999.99", "ok"),
    ("amount", "12345678901234567", "D"), ("amount", "99999999999999999.9", "D"), ("amount", "1E+16", "D"),
    ("amount", "0.00", "D"), ("amount", "NaN", "D"), ("amount", "Infinity", "D"), ("amount", None, "F"), ("amount", "abc", "F"),
    ("amount", "1_000.5", "F"),  # known difference: the reference accepts underscores
    ("currency", " usd ", "ok"), ("currency", " eur", "ok"), ("currency", "123", "ok"), ("currency", "$$$", "ok"),
    ("currency", "a b", "ok"), ("currency", "us", "D"), ("currency", "", "D"), ("currency", "ßab", "D"), ("currency", None, "F"),
    ("transaction_type", "debit", "ok"), ("transaction_type", "credit", "ok"), ("transaction_type", "Debit", "D"),
    ("transaction_type", " debit", "D"), ("transaction_type", "debit ", "D"), ("transaction_type", None, "D"),
    ("status", "pending", "ok"), ("status", "completed", "ok"), ("status", "failed", "ok"), ("status", "PENDING", "D"),
    ("status", None, "D"),
    ("description", None, "ok"), ("description", "", "ok"), ("description", "   ", "ok"),
    ("description", "  " + "y" * 255 + "  ", "ok"), ("description", "y" * 256, "D"),
    ("created_at", "2024-01-01T10:00:00Z", "ok"), ("created_at", "2024-01-01", "ok"), ("created_at", "bad", "F"),
    ("created_at", None, "D"), ("updated_at", "2024-01-01 10:00:00+02:00", "ok"), ("updated_at", None, "D"),
]


@pytest.mark.parametrize("field,value,expected", CASES)
def test_rule_case(spark, field, value, expected):
    assert outcome(evaluate_one(spark, **{field: value})) == expected


def test_normalised_values(spark):
    r = evaluate_one(spark, account_id="{" + UUID.upper() + "}", currency=" usd ", description="   ", category_id="5.0",
                     amount="100.500", updated_at="2024-01-01T10:00:00+02:00")
    assert r["n_account_id"] == UUID
    assert r["n_currency"] == "USD"
    assert r["n_description"] == ""
    assert r["n_category_id"] == 5
    assert r["n_amount"] == Decimal("100.50")
    assert r["n_updated_at"] == dt.datetime(2024, 1, 1, 8, 0)  # offset text read as UTC (F6)


def test_all_errors_in_one_row(spark):
    r = evaluate_one(spark, status="PENDING", currency="us", amount="0.00")
    assert r["errors"] == ["amount_zero", "currency", "status"]


def test_missing_and_unknown_keys(spark):
    df = spark.createDataFrame([("1", UUID, "5", "1.00", "debit", "pending", "2024-01-01", "2024-01-01", "x")],
                               "transaction_id string, account_id string, category_id string, amount string, "
                               "transaction_type string, status string, created_at string, updated_at string, extra string")
    r = R.evaluate(df, R.TRANSACTION_CONTRACT).first()
    # currency and description are absent but have defaults (B10); 'extra' is unknown
    assert r["errors"] == ["unknown:extra"]
    assert r["n_currency"] == "USD" and r["n_description"] is None
    r2 = R.evaluate(df.drop("status", "extra"), R.TRANSACTION_CONTRACT).first()
    assert r2["errors"] == ["missing:status"]  # V16


def test_typed_numbers(spark):
    df = spark.createDataFrame([(5.9, 5.0), (1.0, 5.9)], "transaction_id double, category_id double")
    full = df
    for c in COLS:
        if c not in df.columns:
            full = full.withColumn(c, F.lit(GOOD[c]))
    rows = R.evaluate(full, R.TRANSACTION_CONTRACT).orderBy("transaction_id").collect()
    assert rows[0]["n_transaction_id"] == 1 and rows[0]["errors"] == ["category_id"]  # 5.9 category fails
    assert rows[1]["n_transaction_id"] == 5 and rows[1]["errors"] == []  # 5.9 id cut to 5, 5.0 category passes


def test_json_keys(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": 1, "z": 2}',), ('{"z": 2}',)], "j string")
    got = [r[0] for r in df.select(R.json_key_errors(F.col("j"), ["k"], ["k"])).collect()]
    assert got == [[], ["unknown:z"], ["missing:k", "unknown:z"]]


def test_gates(spark):
    df = spark.createDataFrame([tuple(GOOD[c] if c != "amount" else "abc" for c in COLS)], ", ".join(f"{c} string" for c in COLS))
    with pytest.raises(V.MalformedRowsError):
        V.fatal_gate(R.evaluate(df, R.TRANSACTION_CONTRACT))
    bad = spark.createDataFrame([tuple(GOOD[c] if c != "status" else "x" for c in COLS)], ", ".join(f"{c} string" for c in COLS))
    V.fatal_gate(R.evaluate(bad, R.TRANSACTION_CONTRACT))  # a dead letter is not fatal
    with pytest.raises(V.InvalidRowsError):
        V.strict_gate(R.evaluate(bad, R.TRANSACTION_CONTRACT))


@pytest.mark.parametrize("value,expected", [("yes", True), ("Y", True), ("true", True), ("T", True), ("on", True),
                                            ("1", True), ("0", False), ("off", False), ("2", None), (None, None)])
def test_account_boolean(spark, value, expected):
    df = spark.createDataFrame([(UUID, "n", "savings", "o", "usd", "0.00", value, "2024-01-01", "2024-01-01")],
                               "account_id string, account_name string, account_type string, owner_name string, currency string, "
                               "balance string, is_active string, created_at string, updated_at string")
    r = R.evaluate(df, R.ACCOUNT_CONTRACT).first()
    assert r["n_is_active"] == expected
    assert (r["errors"] == []) == (expected is not None)
    assert r["n_balance"] == Decimal("0.00")  # no zero rule for a balance


def test_account_uuid_is_dead_letter_not_fatal(spark):
    df = spark.createDataFrame([("x", "n", "savings", "o", "2024-01-01", "2024-01-01")],
                               "account_id string, account_name string, account_type string, owner_name string, "
                               "created_at string, updated_at string")
    r = R.evaluate(df, R.ACCOUNT_CONTRACT).first()
    assert r["fatal"] == [] and r["errors"] == ["account_id"]
    assert r["n_currency"] == "USD" and r["n_is_active"] is True  # defaults (B10)


def test_category_contract(spark):
    df = spark.createDataFrame([(0, "n" * 51, "d" * 201, dt.datetime(2024, 1, 1))],
                               "category_id int, name string, description string, updated_at timestamp_ntz")
    r = R.evaluate(df, R.CATEGORY_CONTRACT).first()
    assert r["errors"] == ["category_id", "name", "description"]


@pytest.mark.parametrize("value,expected", [("5.00", "ok"), ("+5", "ok"), ("1E2", "D"), ("5.01", "D"), ("x", "D")])
def test_category_text_forms(spark, value, expected):
    assert outcome(evaluate_one(spark, category_id=value)) == expected


def test_any_bigint_id(spark):
    ids = ["9223372036854775807", "-9223372036854775808", "0" * 30 + "7", "9223372036854775808", "1" * 30]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i int, x string")
    built = key_id("transaction_id")(F.col("x"), frame.schema["x"].dataType)
    got = [(r[0], r[1]) for r in frame.select(built.value, built.fatal, "i").orderBy("i").collect()]
    bad = (None, "transaction_id_type")
    assert got == [(2**63 - 1, None), (-(2**63), None), (7, None), bad, bad]
    number = spark.createDataFrame([(2**63 - 1,)], "x long")
    built = key_id("transaction_id")(F.col("x"), number.schema["x"].dataType)
    assert number.select(built.value, built.fatal).first() == (2**63 - 1, None)


def test_iso_times_as_the_reference_parses_them(spark):
    import datetime as dt

    texts = ["2026-04-17", "20260417", "2026-04-17T11:00:00-05:00", "2026-04-17 11:00", "20260417T110000Z", "2026-04-17T11:00:00.1234567+0530",
             "2026-04-17x11", "2026", "2026-04", "2026-4-7", " 2026-04-17", "2026-04-17 ", "2026-13-01", "2026-04-17T25:00", "2026-04-17T11:00+24:00",
             "2024-11-03T06:30:00Z", "2024-03-10T02:30:00", "2026-04-17T1100:00", "yesterday", ""]

    def want(t):
        try:
            x = dt.datetime.fromisoformat(t.replace("Z", "+00:00"))
        except ValueError:
            return None
        return x if x.tzinfo is None else x.astimezone(dt.timezone.utc).replace(tzinfo=None)

    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = [r[0] for r in frame.select(parse_iso(F.col("t"), frame.schema["t"].dataType), "i").orderBy("i").collect()]
            assert got == [want(t) for t in texts], z
            instant = spark.sql("select timestamp_seconds(1730615400) t")  # 06:30 UTC, in the hour that New York repeats
            assert instant.select(parse_iso(F.col("t"), instant.schema["t"].dataType)).first()[0] == dt.datetime(2024, 11, 3, 6, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_checked_rows_run_compiled(spark):
    """The JVM never compiles a method above 8,000 bytes: every row would then be interpreted."""
    from ledgerline.sources.fixtures import transactions_raw

    k = F.col("id")
    txn = spark.range(200).select(
        (k + 1).alias("transaction_id"), F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(k.cast("string"), 12, "0")).alias("account_id"),
        (k % 10 + 1).cast("int").alias("category_id"), (k / 7).cast("decimal(18,2)").alias("amount"), F.lit("USD").alias("currency"),
        F.lit("debit").alias("transaction_type"), F.lit("pending").alias("status"), k.cast("string").alias("description"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"), F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"),
    )
    raw = transactions_raw(txn).localCheckpoint()
    ev = R.evaluate(raw, R.TRANSACTION_CONTRACT)
    code = ev.select([c for c in ev.columns if c not in raw.columns])._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) <= 8000
    rows = ev.select("is_valid_row", "errors", "fatal").collect()
    assert {r["is_valid_row"] for r in rows} == {True, False}
    assert all(r["is_valid_row"] == (not r["errors"] and not r["fatal"]) for r in rows)
