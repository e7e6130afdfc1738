"""Reports: run metrics, late rows, labelled counts."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import minutes, ntz


def labelled_counts(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``SELECT 'name', COUNT(*) ... UNION ALL ...`` as one frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("table_name"), "total") for name, df in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def recent(df: DataFrame, now: _dt.datetime, within_minutes: int = 1, ts_col: str = "updated_at") -> DataFrame:
    """Rows with ``ts >= now - interval``."""
    return df.where(F.col(ts_col) >= ntz(now) - minutes(within_minutes))


def late_rows(source: DataFrame, target: DataFrame, bound: Column, key: Sequence[str], ts_col: str = "updated_at",
              rejected: DataFrame | None = None) -> DataFrame:
    """Source rows at or under the extract bound that no run loaded or rejected.

    A row was loaded if the target holds its key with the same or a later time. A row was
    rejected if ``rejected`` holds its key and time. What is left committed after a run had
    moved past it, as a new row or as an update, and no later run reads it.
    """
    keys = list(key)
    held = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.col(ts_col).alias("_t_time"))
    same = F.col(ts_col) <= F.col("_t_time")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_t_{k}"))
    out = source.where(F.col(ts_col) <= bound).join(held, same, "left_anti")
    if rejected is not None:
        out = out.join(rejected.select(*keys, ts_col).distinct(), [*keys, ts_col], "left_anti")
    return out


def run_metrics(
    staging: DataFrame,
    chunks: DataFrame,
    dead_letter: DataFrame,
    ledger_current: DataFrame,
    runs: DataFrame | None = None,
) -> DataFrame:
    """Six metrics per run, for all runs at once.

    ``staging``: ``(pipeline_run_id, staging_chunks)`` of the current attempts;
    ``chunks``: the per-chunk table of validated attempts; ``dead_letter``: all attempts,
    of which each run's last one counts, so a replayed run counts its rejects once;
    ``ledger_current``: folded ledger rows. A run missing everywhere gets zeros and a null
    status (give it in ``runs``).
    """
    rid = "pipeline_run_id"
    s = staging.select(rid, "staging_chunks")
    v = chunks.groupBy(rid).agg(F.count(F.lit(1)).alias("validated_chunks"))
    last = ledger_current.select(rid, F.col("last_attempt").alias("attempt"))
    d = dead_letter.join(last, [rid, "attempt"], "left_semi").groupBy(rid).agg(F.count(F.lit(1)).alias("dead_letter_rows"))
    c = ledger_current.select(rid, "chunks_completed", "total_chunks", F.col("status").alias("checkpoint_status"))
    out = s.join(v, rid, "full_outer").join(d, rid, "full_outer").join(c, rid, "full_outer")
    if runs is not None:
        out = runs.select(rid).distinct().join(out, rid, "left")
    return out.select(
        rid,
        F.coalesce("staging_chunks", F.lit(0)).cast("long").alias("staging_chunks"),
        F.coalesce("validated_chunks", F.lit(0)).cast("long").alias("validated_chunks"),
        F.coalesce("dead_letter_rows", F.lit(0)).cast("long").alias("dead_letter_rows"),
        F.coalesce("chunks_completed", F.lit(0)).cast("long").alias("chunks_completed"),
        F.coalesce("total_chunks", F.lit(0)).cast("long").alias("total_chunks"),
        "checkpoint_status",
    )
