"""Split into valid rows and dead letters; fatal and strict gates."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import ntz
from .rules import TRANSACTION_CONTRACT, Contract, evaluate

ERROR_MESSAGE_LIMIT = 20000
# Payload times keep their microseconds.
PAYLOAD_JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
FATAL_SAMPLE = 5


class MalformedRowsError(ValueError):
    """Rows that cannot be normalised: the run stops before any write."""


class InvalidRowsError(ValueError):
    """Strict mode (V19): any invalid row stops the job."""


def keep_if(df: DataFrame, cond: F.Column, cols: Sequence[F.Column]) -> DataFrame:
    """Rows where ``cond`` holds, projected to ``cols``, as a generator rather than a filter.

    Catalyst pushes a filter below projections and repartitions, inlining every rule into
    the predicate: the rules would then run again, without common-subexpression reuse,
    inside the scan stage. A generator that emits zero or one row keeps the rules
    evaluated once, in the stage where ``evaluate`` placed them.
    """
    return df.select(F.inline(F.when(cond, F.array(F.struct(*cols))).otherwise(F.array())))


def valid_rows(evaluated: DataFrame, contract: Contract = TRANSACTION_CONTRACT, keep: Sequence[str] = ()) -> DataFrame:
    """The normalised rows with no error of either class."""
    cols = [F.col(k) for k in keep] + [F.col(f"n_{c}").alias(c) for c in contract.columns]
    return keep_if(evaluated, F.col("is_valid_row"), cols)


def invalid_rows(evaluated: DataFrame) -> DataFrame:
    """Rows with at least one dead-letter code (and, after the gate, no fatal one)."""
    return keep_if(evaluated, (F.size("errors") > 0) & (F.size("fatal") == 0), [F.col(c) for c in evaluated.columns])


def fatal_rows(evaluated: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows that cannot be normalised, with their fatal codes (one per row)."""
    return keep_if(evaluated, F.size("fatal") > 0,
                   [F.col(key).cast("string").alias(key), F.concat_ws(",", "fatal").alias("fatal")])


def fatal_gate(evaluated: DataFrame, key: str = "transaction_id", sample: int = FATAL_SAMPLE) -> None:
    """Raise with a bounded sample when any row is malformed (reads at most
    ``sample`` rows to the driver)."""
    rows = fatal_rows(evaluated, key).limit(sample).collect()
    if rows:
        shown = "; ".join(f"{key}={r[key]}: {r['fatal']}" for r in rows)
        raise MalformedRowsError(f"malformed rows stop the run (first {len(rows)}): {shown}")


def strict_rejects(evaluated: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows with an error of either class, and their codes."""
    return keep_if(evaluated, ~F.col("is_valid_row"),
                   [F.col(key).cast("string").alias(key), F.concat_ws(",", F.concat("fatal", "errors")).alias("codes")])


def strict_gate(evaluated: DataFrame, key: str = "transaction_id", sample: int = FATAL_SAMPLE) -> None:
    """Raise when any row has an error of either class."""
    rows = strict_rejects(evaluated, key).limit(sample).collect()
    if rows:
        shown = "; ".join(f"{key}={r[key]}: {r['codes']}" for r in rows)
        raise InvalidRowsError(f"invalid rows in strict mode (first {len(rows)}): {shown}")


def payload_json(df: DataFrame, columns: Sequence[str]) -> F.Column:
    """The raw row, before normalisation, as JSON text."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), PAYLOAD_JSON_OPTIONS)


def dead_letters(
    evaluated: DataFrame,
    run_id: str,
    attempt: str,
    failed_at: _dt.datetime,
    raw_columns: Sequence[str],
) -> DataFrame:
    """One row per rejected record, all its codes in one message."""
    return invalid_rows(evaluated).select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(attempt).alias("attempt"),
        F.col("chunk_index").cast("int").alias("chunk_index"),
        payload_json(evaluated, raw_columns).alias("payload"),
        F.col("errors"),
        F.substring(F.concat_ws("; ", "errors"), 1, ERROR_MESSAGE_LIMIT).alias("error_message"),
        F.lit(1).alias("attempt_count"),
        ntz(failed_at).alias("failed_at"),
    )


def validate(df: DataFrame, contract: Contract = TRANSACTION_CONTRACT, keep: Sequence[str] = ()) -> DataFrame:
    """Evaluate a contract over a table (``parse_*`` over all rows at once)."""
    return evaluate(df, contract, keep)
