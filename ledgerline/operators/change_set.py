"""Change sets applied to a source table.

The reference seeds its incremental run with SQL: insert new rows, each given an account
by ``a.rn = 1 + seq % (SELECT COUNT(*) FROM accounts)``, and move the 200 oldest pending
rows to completed. Here the new rows come from a given table, so they grow with it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import ntz
from .ranking import Materialize, global_position


def top_keys(df: DataFrame, where: Column, order: Sequence[str | Column], key: Sequence[str], k: int) -> DataFrame:
    """Keys of the first ``k`` rows in ``order`` (``TakeOrderedAndProject``).

    ``k`` is the feature (``ORDER BY ... LIMIT k``); the result has at most ``k`` rows.
    """
    return df.where(where).orderBy(*order).limit(k).select(*key)


def keyed_update(
    df: DataFrame,
    keys: DataFrame,
    key: Sequence[str],
    assignments: dict[str, Column],
) -> DataFrame:
    """M5: ``UPDATE t SET ... WHERE key IN (keys)`` — a left join flag and ``when``.
    """
    hits = keys.withColumn("_hit", F.lit(True))
    flagged = df.join(hits, list(key), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = [F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c) for c in df.columns]
    return flagged.select(*out)


def oldest_pending_to_completed(txn: DataFrame, now: _dt.datetime, k: int = 200) -> DataFrame:
    """The 200 oldest pending rows (by ``created_at``, then key) become completed, and
    their ``updated_at`` is bumped to ``now``."""
    keys = top_keys(txn, F.col("status") == "pending", ["created_at", "transaction_id"], ["transaction_id"], k)
    return keyed_update(txn, keys, ["transaction_id"], {"status": F.lit("completed"), "updated_at": ntz(now)})


def numbered(df: DataFrame, order: Sequence[str], name: str = "rn", materialize: Materialize | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY ...)`` with the order made explicit, without a
    one-task window."""
    return global_position(df, order, name, materialize)


def assign_round_robin(seq_rows: DataFrame, seq: str, numbered_side: DataFrame, count: int, rn: str = "rn") -> DataFrame:
    """Join each sequence row to ``numbered_side`` on ``rn = 1 + seq % count``."""
    key = (F.lit(1) + F.pmod(F.col(seq), F.lit(count))).cast("long")
    return seq_rows.withColumn("_rn", key).join(numbered_side.withColumnRenamed(rn, "_rn"), "_rn").drop("_rn")


def pick(seq: Column, values: Sequence[str]) -> Column:
    """``(ARRAY[...])[1 + seq % n]``."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.lit(1) + F.pmod(seq, F.lit(len(values)))).cast("int"))


def with_round_robin(rows: DataFrame, seq: str, side: DataFrame, key: str, materialize: Materialize | None = None) -> DataFrame:
    """Give each row of ``rows`` one row of ``side``, numbered by ``key``, in turn."""
    count = side.count()  # G7: the scalar COUNT(*), one number to the driver
    return assign_round_robin(rows, seq, numbered(side, [key], "rn", materialize), count)


def apply_change_set(txn: DataFrame, inserts: DataFrame, now: _dt.datetime, k: int = 200) -> DataFrame:
    """M6: the updates of M5 on the table, plus the inserted rows."""
    return oldest_pending_to_completed(txn, now, k).unionByName(inserts.select(*txn.columns))
