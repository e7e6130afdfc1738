"""Derived views over the given test tables (the tables hold no transactions).

Every view is a per-row projection (or a filter) of a given table, so each one works in a
batch and in a streaming plan, and its size grows with the table it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.change_set import pick
from .tables import read_table

_UUID_SHAPE = r"^(.{8})(.{4})(.{4})(.{4})(.{12})$"
_UUID_JOIN = "$1-$2-$3-$4-$5"


def md5_uuid(c: Column) -> Column:
    """A stable UUID text from a key: its md5 hex laid out 8-4-4-4-12."""
    return F.regexp_replace(F.md5(c.cast("string")), _UUID_SHAPE, _UUID_JOIN)


def _pick3(k: Column, a: str, b: str, c: str) -> Column:
    return F.when(k % 3 == 0, a).when(k % 3 == 1, b).otherwise(c)


def _secs(c: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), c)


def transactions(orders: DataFrame) -> DataFrame:
    """``transactions`` from ``orders``: key unique, types as the source DDL."""
    k = F.col("o_orderkey")
    return orders.select(
        (k + 1).alias("transaction_id"),
        md5_uuid(F.col("o_custkey")).alias("account_id"),
        (F.lit(1) + k % 10).cast("int").alias("category_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        _pick3(k, "USD", "EUR", "COP").alias("currency"),
        F.when(k % 2 == 0, "debit").otherwise("credit").alias("transaction_type"),
        F.when(F.col("o_orderstatus") == "O", "pending")
        .when(F.col("o_orderstatus") == "F", "completed")
        .otherwise("failed")
        .alias("status"),
        F.concat(F.lit("order "), k.cast("string")).alias("description"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderdate") + _secs(k % 86400)).alias("updated_at"),
    )


def transactions_raw(txn: DataFrame) -> DataFrame:
    """Dirty text form of ``transactions``: amount as text, some values broken on purpose."""
    r = F.col("transaction_id") % 97
    return txn.select(
        F.when(r == 16, -F.col("transaction_id")).otherwise(F.col("transaction_id")).alias("transaction_id"),
        F.when(r != 13, F.col("account_id")).alias("account_id"),
        F.when(r == 6, F.lit(0)).otherwise(F.col("category_id")).cast("int").alias("category_id"),
        F.when(r == 0, "0.00")
        .when(r == 7, "1.005")
        .when(r == 10, "100.500")
        .when(r == 11, "12345678901234567.00")
        .otherwise(F.col("amount").cast("string"))
        .alias("amount"),
        F.when(r == 2, " usd ").when(r == 3, "US").when(r == 12, "$$$").otherwise(F.col("currency")).alias("currency"),
        F.when(r == 5, F.concat(F.lit(" "), F.col("transaction_type"))).otherwise(F.col("transaction_type")).alias(
            "transaction_type"
        ),
        F.when(r == 1, F.upper("status")).otherwise(F.col("status")).alias("status"),
        F.when(r == 4, F.repeat(F.lit("x"), 256))
        .when(r == 8, F.lit(None).cast("string"))
        .when(r == 9, F.concat(F.lit("  "), F.col("description"), F.lit("  ")))
        .otherwise(F.col("description"))
        .alias("description"),
        F.when(r != 14, F.col("created_at")).alias("created_at"),
        F.when(r != 15, F.col("updated_at")).alias("updated_at"),
    )


def transactions_text(txn: DataFrame) -> DataFrame:
    """All-text form of ``transactions`` (as staged JSON values arrive), with malformed
    values that no rule can dead-letter: they stop a run (class F)."""
    r = F.col("transaction_id") % 89
    s = lambda name: F.col(name).cast("string")
    return txn.select(
        F.when(r == 1, F.concat(s("transaction_id"), F.lit(".5")))
        .when(r == 11, (F.lit(9_000_000_000_000_000_000) + F.col("transaction_id")).cast("string"))
        .when(r == 12, F.concat(F.lit("0" * 20), s("transaction_id")))
        .when(r == 13, F.concat(F.lit("9" * 19), s("transaction_id")))
        .otherwise(s("transaction_id"))
        .alias("transaction_id"),
        F.when(r == 2, F.lit("not-a-uuid"))
        .when(r == 3, F.upper(F.regexp_replace("account_id", "-", "")))
        .when(r == 4, F.concat(F.lit("{"), F.col("account_id"), F.lit("}")))
        .otherwise(F.col("account_id"))
        .alias("account_id"),
        s("category_id").alias("category_id"),
        F.when(r == 5, F.lit("abc")).when(r == 6, F.lit(None).cast("string")).otherwise(s("amount")).alias("amount"),
        F.when(r == 7, F.lit(None).cast("string")).otherwise(F.col("currency")).alias("currency"),
        "transaction_type",
        "status",
        "description",
        F.when(r == 8, F.lit("yesterday")).otherwise(s("created_at")).alias("created_at"),
        F.when(r == 9, F.lit("bad")).when(r == 10, F.concat(F.substring(s("updated_at"), 1, 10), F.lit("T12:00:00Z")))
        .when(r == 14, F.concat(F.substring(s("updated_at"), 1, 10), F.lit("T21:30:00-05:00")))
        .when(r == 15, F.concat(F.substring(s("updated_at"), 1, 10), F.lit(" 03:00+0530")))
        .when(r == 16, F.regexp_replace(F.substring(s("updated_at"), 1, 10), "-", ""))
        .otherwise(s("updated_at"))
        .alias("updated_at"),
    )


def accounts(customer: DataFrame, *more: Column) -> DataFrame:
    k = F.col("c_custkey")
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return customer.select(
        md5_uuid(k).alias("account_id"),
        F.concat(F.lit("customer "), F.lpad(k.cast("string"), 9, "0")).alias("account_name"),
        _pick3(k, "savings", "checking", "investment").alias("account_type"),
        F.col("c_name").alias("owner_name"),
        _pick3(k, "USD", "EUR", "COP").alias("currency"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
        (k % 20 != 0).alias("is_active"),
        base.alias("created_at"),
        (base + _secs(k % 86400)).alias("updated_at"),
        *more,
    )


def categories(nation: DataFrame) -> DataFrame:
    return nation.select(
        (F.col("n_nationkey") + 1).cast("int").alias("category_id"),
        F.lower("n_name").alias("name"),
        F.lit(None).cast("string").alias("description"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )


def accounts_raw(acc: DataFrame, customer_key: Column) -> DataFrame:
    """Dirty form of ``accounts``: each rule of the account contract has rows that break it."""
    r = customer_key % 41
    set_ = lambda name, at, value: F.when(r == at, value).otherwise(F.col(name)).alias(name)
    text = lambda x: F.lit(x).cast("string")
    return acc.select(
        set_("account_id", 1, text("no-uuid")),
        set_("account_name", 2, text(None)),
        set_("account_type", 3, F.upper("account_type")),
        set_("owner_name", 4, F.repeat(F.lit("o"), 101)),
        set_("currency", 5, text("US")),
        F.when(r == 6, "12345678901234567.00").when(r == 7, "1.005").otherwise(F.col("balance").cast("string")).alias("balance"),
        F.when(r != 8, F.col("is_active")).alias("is_active"),
        F.when(r != 9, F.col("created_at")).alias("created_at"),
        F.when(r != 10, F.col("updated_at")).alias("updated_at"),
    )


def categories_raw(cat: DataFrame) -> DataFrame:
    """Dirty form of ``categories``: each rule of the category contract has a row that breaks it."""
    k = F.col("category_id")
    return cat.select(
        F.when(k == 4, 0).otherwise(k).cast("int").alias("category_id"),
        F.when(k == 6, F.lit(None).cast("string")).when(k == 8, F.repeat("name", 51)).otherwise(F.col("name")).alias("name"),
        F.when(k == 10, F.repeat(F.lit("d"), 201)).otherwise(F.col("description")).alias("description"),
        F.when(k != 12, F.col("updated_at")).alias("updated_at"),
    )


def event_props(events: DataFrame) -> DataFrame:
    """``events`` with a ``props`` document that has a key too many or too few on some rows."""
    r = F.col("event_id") % 50
    props = F.when(r == 1, '{"k": 1, "extra": 2}').when(r == 2, '{"extra": 2}').when(r == 3, "{}").otherwise(F.col("props"))
    return events.withColumn("props", props)


def event_transactions(numbered: DataFrame, first_id: int, now: Column) -> DataFrame:
    """M6 inserts: a completed transaction per event, from rows ``(seq, event_type, value,
    account_id)``; ids follow ``first_id``."""
    s = F.col("seq")
    return numbered.select(
        (F.lit(first_id) + s).alias("transaction_id"),
        "account_id",
        (F.lit(1) + F.pmod(s, F.lit(25))).cast("int").alias("category_id"),
        F.round(F.abs("value").cast("decimal(18,2)") + F.lit(1), 2).cast("decimal(18,2)").alias("amount"),
        pick(s, ["CHF", "USD", "JPY", "EUR"]).alias("currency"),
        F.when(F.col("event_type") == "purchase", "debit").otherwise("credit").alias("transaction_type"),
        F.lit("completed").alias("status"),
        # a letter code and a padded number
        F.concat(F.col("event_type"), F.lit(" "), F.char(F.lit(65) + F.pmod(s, F.lit(26))), F.lpad(s.cast("string"), 9, "0")).alias("description"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )


def ledger_rows(events: DataFrame) -> DataFrame:
    """A ledger of current rows, one run per event: status by ``event_type``."""
    return events.select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("pipeline_run_id"),
        F.col("ts").alias("last_watermark"),
        F.when(F.col("event_type") == "purchase", "completed")
        .when(F.col("event_type") == "error", "failed")
        .otherwise("running")
        .alias("status"),
    )


class Fixtures:
    """Lazily derived views over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def transactions(self) -> DataFrame:
        return transactions(self.table("orders"))

    def transactions_raw(self) -> DataFrame:
        return transactions_raw(self.transactions())

    def transactions_text(self) -> DataFrame:
        return transactions_text(self.transactions())

    def accounts(self) -> DataFrame:
        return accounts(self.table("customer"))

    def categories(self) -> DataFrame:
        return categories(self.table("nation"))

    def accounts_raw(self) -> DataFrame:
        customer = self.table("customer")
        with_key = accounts(customer, F.col("c_custkey").alias("_key"))
        return accounts_raw(with_key, F.col("_key"))

    def categories_raw(self) -> DataFrame:
        return categories_raw(self.categories())

    def ledger_rows(self) -> DataFrame:
        return ledger_rows(self.table("events"))
