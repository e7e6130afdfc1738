"""The continuous form of the pipeline as a Structured Streaming job.

The file source tracks which files it has read in its checkpoint, so each micro-batch is
a change set. ``foreachBatch`` runs the batch pipeline on it: stage (the materialisation
point), validate with dead letters, upsert into the reporting table, then the ledger event.
The run id is ``stream-<name>-<batchId>``: a batch replayed after a crash is a new
attempt of the same run: the upsert is idempotent, and reports count the rejects of a run's
last attempt only.

With ``event_time.mark_late`` before it, the stream applies the watermark rule: rows that came
later than the allowed delay are written to ``late_rows`` and not loaded.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import LedgerPipeline


def stream_run_id(name: str, batch_id: int) -> str:
    return f"stream-{name}-{batch_id}"


def upsert_batches(
    pipeline: LedgerPipeline, name: str, now: Callable[[], _dt.datetime], compact_every: int | None = 100
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: one pipeline run per micro-batch; every
    ``compact_every`` batches the ledger's files are merged by day (a long-running stream
    would otherwise leave a few small files per batch)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if "late" in batch.columns:
            batch = keep_late(pipeline, batch, batch_id)
        pipeline.run_pipeline(stream_run_id(name, batch_id), batch, now(), finalize=True, use_watermark=False)
        if compact_every and batch_id % compact_every == compact_every - 1:
            pipeline.ledger.compact()

    return handle


def late_path(pipeline: LedgerPipeline) -> str:
    return f"{pipeline.ws.root}/late_rows"


def keep_late(pipeline: LedgerPipeline, batch: DataFrame, batch_id: int) -> DataFrame:
    """Write a batch of ``mark_late`` once, by ``late``, and return its rows on time.

    A replayed batch overwrites what its first attempt wrote.
    """
    path = f"{late_path(pipeline)}/batch={batch_id}"
    batch.write.mode("overwrite").partitionBy("late").parquet(path)
    written = batch.sparkSession.read.schema(batch.schema).parquet(path)
    return written.where(~F.col("late")).drop("late")


def late_rows(pipeline: LedgerPipeline) -> DataFrame:
    """K4: the rows that came after the watermark, with the batch that brought them."""
    rows = pipeline.spark.read.parquet(late_path(pipeline))
    return rows.where(F.col("late").cast("boolean")).drop("late")


def start_upsert_stream(
    spark: SparkSession,
    stream: DataFrame,
    pipeline: LedgerPipeline,
    name: str,
    checkpoint: str,
    now: Callable[[], _dt.datetime] | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    compact_every: int | None = 100,
) -> StreamingQuery:
    """Start the stream; ``available_now`` drains what exists and stops (a scheduled run)."""
    stamp = now or (lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    writer = stream.writeStream.foreachBatch(upsert_batches(pipeline, name, stamp, compact_every)).option(
        "checkpointLocation", checkpoint
    ).queryName(f"ledgerline_{name}_{uuid.uuid4().hex[:8]}")  # unique: concurrent streams may share a name
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def file_glob(path: str) -> str:
    """A glob that matches exactly one file: the file source lists directories or globs,
    never a plain file path."""
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/[{name[0]}]{name[1:]}"


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """A file-source stream with a declared schema (nothing inferred)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
