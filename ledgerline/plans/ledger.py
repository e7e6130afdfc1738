"""Checkpoint ledger as append-only state events.

Each state change is one event row. The current row of a run is a fold of its events:
``groupBy(run)`` with ``max_by`` / ``sum`` / ``max``, never a global window. Events of a run before its first ``start`` are
ignored, so an update of an unknown run changes nothing (T11).

Events:
  ``start``   (K5) status running; the first one sets the initial watermark and started_at,
              later ones keep watermark and counters (T6)
  ``total``   (K6) total_chunks
  ``advance`` (K7) GREATEST(watermark, chunk watermark), chunks_completed + delta
  ``finish``  (K8) status completed / failed
  ``attempt`` buffer attempt of the run (A2, A4, A8); null clears it
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.temporal import extract_since, ntz
from ..schemas import EPOCH, LEDGER_STATUSES

def check_status(status: str) -> str:
    """The ledger accepts these statuses only."""
    if status not in LEDGER_STATUSES:
        raise ValueError(f"status {status!r} is none of {LEDGER_STATUSES}")
    return status


def fold(events: DataFrame) -> DataFrame:
    """K9: current row per run from its events (the ledger table of the reference)."""
    # the window and the aggregate share one shuffle on the run id
    first = F.min(F.when(F.col("event") == "start", F.col("seq"))).over(Window.partitionBy("pipeline_run_id"))
    live = events.withColumn("_first_start", first).where(
        F.col("_first_start").isNotNull() & (F.col("seq") >= F.col("_first_start"))
    )
    is_start = F.col("event") == "start"
    is_first = is_start & (F.col("seq") == F.col("_first_start"))
    status_of = F.when(is_start, F.lit("running")).when(F.col("event") == "finish", F.col("status"))
    agg = live.groupBy("pipeline_run_id").agg(
        F.max(F.when(is_first, F.col("last_watermark"))).alias("_initial"),
        F.max(F.when(F.col("event") == "advance", F.col("last_watermark"))).alias("_advanced"),
        F.coalesce(F.sum(F.when(F.col("event") == "advance", F.col("chunks_delta"))), F.lit(0)).cast("int").alias(
            "chunks_completed"
        ),
        F.max_by(F.col("total_chunks"), F.when(F.col("event") == "total", F.col("seq"))).alias("total_chunks"),
        F.max_by(status_of, F.when(status_of.isNotNull(), F.col("seq"))).alias("status"),
        F.max_by(F.col("attempt"), F.when(F.col("event").isin("start", "attempt"), F.col("seq"))).alias("attempt"),
        F.max_by(F.col("attempt"), F.when(F.col("attempt").isNotNull(), F.col("seq"))).alias("last_attempt"),
        F.max(F.when(is_first, F.col("at"))).alias("started_at"),
        F.max("at").alias("updated_at"),
    )
    return agg.select(
        "pipeline_run_id",
        F.greatest(F.col("_initial"), F.coalesce(F.col("_advanced"), F.col("_initial"))).alias("last_watermark"),
        "chunks_completed",
        "total_chunks",
        "status",
        "attempt",
        "last_attempt",
        "started_at",
        "updated_at",
    )


def last_completed_watermark(current: DataFrame) -> DataFrame:
    """G1: one row, ``MAX(last_watermark)`` over completed runs (null when none, T4)."""
    return current.where(F.col("status") == "completed").agg(F.max("last_watermark").alias("last_completed_watermark"))


def resume_point(current: DataFrame, overlap_minutes: int = 5) -> DataFrame:
    """K1 / K2 / K3: one row with the last completed watermark, the extract bound
    (minus the overlap) and the initial watermark of a new run (epoch when none, T5)."""
    last = F.col("last_completed_watermark")
    return last_completed_watermark(current).select(
        last,
        extract_since(last, overlap_minutes).alias("extract_since"),
        F.coalesce(last, ntz(EPOCH)).alias("initial_watermark"),
    )


def progress(chunks: DataFrame, initial: _dt.datetime, base_completed: int = 0, block: int = 65536) -> DataFrame:
    """Running watermark and completed count as the chunks of a run load.

    ``chunks`` has ``chunk_index`` (dense from 0) and ``chunk_high_watermark``.
    """
    from ..operators.ranking import running_max

    run = running_max(chunks, "chunk_index", "chunk_high_watermark", "last_watermark", block, ntz(initial))
    return run.withColumn("chunks_completed", (F.col("chunk_index") + 1 + F.lit(base_completed)).cast("int"))
