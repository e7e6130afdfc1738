"""Every table schema, declared once (nothing is inferred)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

EPOCH = _dt.datetime(1970, 1, 1)

MONEY = T.DecimalType(18, 2)

# Contract columns of a transaction, in extract order (B1).
TRANSACTION_COLUMNS = [
    "transaction_id",
    "account_id",
    "category_id",
    "amount",
    "currency",
    "transaction_type",
    "status",
    "description",
    "created_at",
    "updated_at",
]

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.LongType(), False),
        T.StructField("account_id", T.StringType(), False),
        T.StructField("category_id", T.IntegerType(), False),
        T.StructField("amount", MONEY, False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("transaction_type", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("updated_at", T.TimestampNTZType(), False),
    ]
)

# Target reporting table: the 10 columns plus two load columns.
FINANCIAL_RECORDS = T.StructType(
    TRANSACTIONS.fields
    + [
        T.StructField("source_updated_at", T.TimestampNTZType(), False),
        T.StructField("loaded_at", T.TimestampNTZType(), False),
    ]
)

ACCOUNTS = T.StructType(
    [
        T.StructField("account_id", T.StringType(), False),
        T.StructField("account_name", T.StringType(), False),
        T.StructField("account_type", T.StringType(), False),
        T.StructField("owner_name", T.StringType(), False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("balance", MONEY, False),
        T.StructField("is_active", T.BooleanType(), False),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("updated_at", T.TimestampNTZType(), False),
    ]
)

CATEGORIES = T.StructType(
    [
        T.StructField("category_id", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("updated_at", T.TimestampNTZType(), False),
    ]
)

# Ledger: append-only state events; the current row per run is folded from them.
LEDGER_EVENTS = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("pipeline_run_id", T.StringType(), False),
        T.StructField("event", T.StringType(), False),
        T.StructField("last_watermark", T.TimestampNTZType(), True),
        T.StructField("chunks_delta", T.IntegerType(), True),
        T.StructField("total_chunks", T.IntegerType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("attempt", T.StringType(), True),
        T.StructField("at", T.TimestampNTZType(), False),
    ]
)

# Offsets of a staged attempt: one row per sorted partition.
OFFSETS = T.StructType(
    [
        T.StructField("pipeline_run_id", T.StringType(), False),
        T.StructField("_part", T.IntegerType(), False),
        T.StructField("_first", T.LongType(), False),
        T.StructField("_n", T.LongType(), False),
        T.StructField("_offset", T.LongType(), False),
        T.StructField("chunk_size", T.IntegerType(), False),
    ]
)

# Per-chunk table of a validated attempt: an empty chunk still has a row.
CHUNK_TABLE = T.StructType(
    [
        T.StructField("pipeline_run_id", T.StringType(), False),
        T.StructField("chunk_index", T.IntegerType(), False),
        T.StructField("raw_rows", T.LongType(), False),
        T.StructField("valid_rows", T.LongType(), False),
        T.StructField("source_high_watermark", T.TimestampNTZType(), False),
    ]
)

# Dead letters: append-only, one row per rejected record, all its codes.
DEAD_LETTER = T.StructType(
    [
        T.StructField("pipeline_run_id", T.StringType(), False),
        T.StructField("attempt", T.StringType(), False),
        T.StructField("chunk_index", T.IntegerType(), False),
        T.StructField("payload", T.StringType(), False),
        T.StructField("errors", T.ArrayType(T.StringType(), True), False),
        T.StructField("error_message", T.StringType(), False),
        T.StructField("attempt_count", T.IntegerType(), False),
        T.StructField("failed_at", T.TimestampNTZType(), False),
    ]
)

LEDGER_STATUSES = ("running", "completed", "failed")
