"""The incremental pipeline as Spark jobs: extract, validate, load, report, finalize.

P1 ``run_extraction``  K1, A8, K5, A1, W2, A2, K6, G4
P2 ``run_validation``  A3, B4, V1-V18, A4, A6, G2, G5
P3 ``run_load``        A5, B5, M1, K7, W3, G6
P4 ``run_metrics``     G3, K9
P5 ``run_finalize``    K8, A8
P6 ``run_smoke_transfer``  S2, V19, B5, M1
P7 ``run_pipeline``    all of the above in order

Control stays in the driver; each stage is one or a few lazy plans whose only actions are
writes plus bounded reads (a resume scalar, a fatal sample of at most five rows). Row counts
come out of the writes themselves (``DataFrame.observe``). Commit order: staging, dead letter
and validated rows, table, ledger event last (T22). Load is atomic per run.
"""

from __future__ import annotations

import datetime as _dt
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import ntz
from ..operators import extract as X
from ..operators import rules as R
from ..operators import validate as V
from ..operators.load import load_projection
from ..operators.ranking import apply_offsets, chunk_of, partition_offsets, tag_sorted
from ..schemas import CHUNK_TABLE, DEAD_LETTER, EPOCH, FINANCIAL_RECORDS, LEDGER_EVENTS, OFFSETS
from ..sources.store import (
    RECORD_TIME_FORMAT,
    RangeTable,
    Workspace,
    commit_records,
    delete_path,
    finish_replace,
    has_data_file,
    has_parquet,
    read_or_empty,
    read_records,
    replace_partitions,
    run_folder,
)
from ..session import scratch_path
from . import ledger as L
from . import report as P

class StageError(RuntimeError):
    """A stage failed; the run is marked failed in the ledger (unlike the reference, T21)."""


@dataclass
class PipelineConfig:
    chunk_size: int = X.DEFAULT_CHUNK_SIZE
    overlap_minutes: float = X.DEFAULT_OVERLAP_MINUTES
    on_duplicate: str = "latest"  # T13: later chunk wins; or 'fail'
    guard: str | None = None  # T12: no guard by default; 'updated_at' to skip stale changes
    on_malformed: str = "stop"  # V18: 'stop' the run, or 'dead_letter' the malformed rows
    range_width: int | None = None  # keys per partition of the reporting table; by default the stored or usual one

    def __post_init__(self) -> None:
        X.check_parameters(self.chunk_size, self.overlap_minutes)
        if self.on_malformed not in ("stop", "dead_letter"):
            raise ValueError("on_malformed must be 'stop' or 'dead_letter'")


class LedgerStore:
    """Append-only ledger events; the current state is their fold (K9).

    One small file per commit in the folder of its day; ``compact`` merges them.
    """

    SCHEMA = T.StructType([*LEDGER_EVENTS.fields, T.StructField("day", T.DateType())])
    FORMAT = {"timestampNTZFormat": RECORD_TIME_FORMAT}

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._seq: int | None = None  # single writer: the last seq, read once
        self._states: dict[str, dict | None] = {}  # fold of one run, until its next event

    def is_empty(self) -> bool:
        return not has_data_file(self.spark, self.path, ".json")

    def _stored(self) -> DataFrame:
        finish_replace(self.spark, self.path, self.SCHEMA, "day", "json", **self.FORMAT)
        if self.is_empty():
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).options(**self.FORMAT).json(self.path)

    def events(self) -> DataFrame:
        return self._stored().drop("day")

    def compact(self) -> int:
        """Merge the files of every day that has several of them; the events stay as they are.

        Each day is one task's work. Returns the last seq. Nothing reaches the driver but that.
        """
        files = self._stored().select("day", F.input_file_name().alias("file")).distinct()
        full = files.groupBy("day").count().where("count > 1")
        replace_partitions(self._stored().join(full, "day", "left_semi").repartition("day"), self.path, "day", "json", **self.FORMAT)
        return self.next_seq() - 1

    def current(self) -> DataFrame:
        return L.fold(self.events())

    def next_seq(self) -> int:
        if self._seq is None:
            v = self.events().agg(F.max("seq")).first()[0]
            self._seq = int(v) if v is not None else 0
        return self._seq + 1

    def append(self, run_id: str, event: str, at: _dt.datetime, **values) -> int:
        return self.append_many(run_id, at, [(event, values)])

    def append_many(self, run_id: str, at: _dt.datetime, events: list[tuple[str, dict]]) -> int:
        """Append events of one run in order, as one file (one commit); returns the last seq."""
        first = self.next_seq()
        rows = [{"seq": first + i, "pipeline_run_id": run_id, "event": e, "at": at, **v} for i, (e, v) in enumerate(events)]
        commit_records(self.spark, f"{self.path}/day={at.date().isoformat()}", f"{first:020d}.json", rows)
        self._seq = first + len(rows) - 1
        self._states.pop(run_id, None)
        return self._seq

    def state(self, run_id: str) -> dict | None:
        if run_id not in self._states:
            if self.is_empty():
                return None
            rows = self.current().where(F.col("pipeline_run_id") == run_id).collect()
            self._states[run_id] = rows[0].asDict() if rows else None
        return self._states[run_id]


def newest_rows(source: DataFrame, limit: int, time: str, key: str) -> DataFrame:
    """The ``limit`` newest rows, ties by the greatest key.

    The time of the last of them is found first, from the time column alone; as a lower bound it
    then reaches the scan, so whole rows are read only where newer ones lie. Rows at the bound stay.
    """
    rows = source
    if isinstance(source.schema[time].dataType, T.TimestampNTZType):
        last = source.select(time).orderBy(F.col(time).desc()).limit(limit).agg(F.min(time), F.count(time)).first()
        if last[1] == limit:  # fewer: rows without a time belong to the result
            rows = source.where(F.col(time) >= ntz(last[0]))
    return rows.orderBy(F.col(time).desc(), F.col(key).desc()).limit(limit)


def newest_valid_rows(source: DataFrame, contract: R.Contract, limit: int) -> DataFrame:
    """The newest ``limit`` rows, read once, normalised; any invalid one raises."""
    top = newest_rows(source, limit, "updated_at", contract.key[0])
    path = scratch_path(source.sparkSession, "newest")
    top.select(*contract.columns).write.parquet(path)
    ev = R.evaluate(source.sparkSession.read.parquet(path), contract)
    V.strict_gate(ev)
    return V.valid_rows(ev, contract)


class LedgerPipeline:
    """One pipeline over one storage root: the six operations of the reference's DAGs."""

    def __init__(self, spark: SparkSession, root: str, config: PipelineConfig | None = None,
                 contract: R.Contract = R.TRANSACTION_CONTRACT):
        self.spark = spark
        self.config = config or PipelineConfig()
        self.contract = contract
        self.ws = Workspace(spark, root)
        self.ledger = LedgerStore(spark, self.ws.ledger_path)
        self.target = RangeTable(
            spark, f"{self.ws.root}/financial_records", FINANCIAL_RECORDS, contract.key, self.config.range_width
        )
        self._attempts: dict[str, str | None] = {}  # attempts this instance wrote to the ledger

    # -------------------------------------------------------------- K1
    def resume_point(self) -> tuple[_dt.datetime, _dt.datetime, _dt.datetime | None]:
        """(extract_since, initial_watermark, last_completed) from the ledger."""
        if self.ledger.is_empty():  # empty ledger: the first run (T5), no job needed
            return EPOCH - _dt.timedelta(minutes=self.config.overlap_minutes), EPOCH, None
        row = L.resume_point(self.ledger.current(), self.config.overlap_minutes).first()
        return row["extract_since"], row["initial_watermark"], row["last_completed_watermark"]

    def _attempt(self, run_id: str) -> str | None:
        """The run's current attempt: the one this instance started, else from the ledger
        (stages may run in separate processes)."""
        if run_id in self._attempts:
            return self._attempts[run_id]
        st = self.ledger.state(run_id)
        return st["attempt"] if st else None

    # -------------------------------------------------------------- P1
    def run_extraction(self, run_id: str, source: DataFrame, now: _dt.datetime, use_watermark: bool = True) -> dict:
        cfg = self.config
        since, initial, _ = self.resume_point()  # T7: read before the run row is restarted
        # A8 then K5: hide the old buffers and start (or restart, T6) with a new attempt in
        # one commit, then delete the old attempt folders; nothing reads them any more.
        attempt = f"a{self.ledger.next_seq() + 1}"
        self.ledger.append_many(run_id, now, [
            ("attempt", {"attempt": None}),
            ("start", {"last_watermark": initial, "attempt": attempt, "status": "running"}),
        ])
        self._attempts[run_id] = attempt
        self.ws.clear_run(run_id)
        extract = X.incremental_extract(source, since) if use_watermark else source.select(*self.contract.columns)
        staged_path = self.ws.buffer("staging_rows", run_id, attempt)
        seen = Observation("staging")
        tagged = tag_sorted(extract, X.extract_order(extract)).withColumn("pipeline_run_id", F.lit(run_id))
        tagged.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged_path)
        staged = self.spark.read.parquet(staged_path)
        # one row per sorted partition, kept as a table beside the rows
        offsets = self.ws.buffer("staging_offsets", run_id, attempt)
        partition_offsets(staged).select(
            F.lit(run_id).alias("pipeline_run_id"), "_part", "_first", "_n", "_offset",
            F.lit(cfg.chunk_size).alias("chunk_size"),
        ).write.json(offsets)
        rows = seen.get["rows"]
        total = math.ceil(rows / cfg.chunk_size)
        self.ledger.append(run_id, "total", now, total_chunks=total)  # K6
        return {"pipeline_run_id": run_id, "chunk_count": total, "extract_since": since.isoformat(), "row_count": rows}

    def staging_rows(self, run_id: str) -> DataFrame:
        """A3: staged rows of the current attempt with position and chunk index."""
        attempt = self._attempt(run_id)
        if attempt is None:
            raise StageError(f"run {run_id} has no staged attempt")
        staged = self.spark.read.parquet(self.ws.buffer("staging_rows", run_id, attempt))
        offsets = self._offset_rows(run_id, attempt)
        first = offsets.select("chunk_size").first()  # the same in each row
        size = first[0] if first else self.config.chunk_size
        return apply_offsets(staged, offsets.drop("pipeline_run_id", "chunk_size", "_n")).withColumn(
            "chunk_index", chunk_of(F.col("position"), size)
        )

    def _offset_rows(self, run_id: str, attempt: str) -> DataFrame:
        return read_records(self.spark, self.ws.buffer("staging_offsets", run_id, attempt), OFFSETS)

    # -------------------------------------------------------------- P2
    def run_validation(self, run_id: str, now: _dt.datetime) -> dict:
        """P2. The rules are evaluated once: the evaluated change set (normalised columns,
        codes, the raw payload of rejected rows) is the validated buffer of the attempt.
        The chunk table, the fatal gate, the dead letters and the load all read it. A run
        without a staged attempt has nothing to validate: zeros, as on a retry."""
        attempt = self._attempt(run_id)
        if attempt is None:
            return {"pipeline_run_id": run_id, "dlq_count": 0, "chunks_validated": 0}
        staged = self.staging_rows(run_id)
        keep = ("pipeline_run_id", "position", "chunk_index")
        raw_cols = [c for c in staged.columns if c not in keep]
        ev = R.evaluate(staged, self.contract, keep=keep)
        if self.config.on_malformed == "dead_letter":
            ev = ev.withColumn("errors", F.concat("fatal", "errors")).withColumn("fatal", F.array().cast("array<string>"))
        bad = ~F.col("is_valid_row")
        rows_path = self.ws.buffer("validated_rows", run_id, attempt)
        checked = Observation("validated")
        evaluated = ev.select(
            *keep,
            *[F.col(f"n_{c}").alias(c) for c in self.contract.columns],
            "is_valid_row",
            F.when(bad, F.col("errors")).alias("errors"),
            F.when(bad, F.col("fatal")).alias("fatal"),
            F.when(bad, V.payload_json(ev, raw_cols)).alias("payload"),
        )
        malformed = F.count_if(F.coalesce(F.size("fatal"), F.lit(0)) > 0)
        evaluated.observe(checked, F.count_if(bad).alias("rejected"), malformed.alias("malformed")).write.parquet(rows_path)
        done = self.spark.read.parquet(rows_path)
        if checked.get["malformed"]:
            try:  # V18: stops before any dead letter or load
                V.fatal_gate(done.where(F.size("fatal") > 0), key="position")
            finally:
                delete_path(self.spark, rows_path)
        # G2 + T8: rows, valid rows and the watermark over all rows per chunk (``updated_at``
        # holds the parsed time of invalid rows too).
        chunks_path = self.ws.buffer("validated_chunks", run_id, attempt)
        counted = Observation("chunks")
        chunks = done.groupBy("chunk_index").agg(
            F.count(F.lit(1)).alias("raw_rows"),
            F.count_if("is_valid_row").alias("valid_rows"),
            F.coalesce(F.max("updated_at"), ntz(EPOCH)).alias("source_high_watermark"),
        ).select(F.lit(run_id).alias("pipeline_run_id"), F.col("chunk_index").cast("int"), "raw_rows", "valid_rows",
                 "source_high_watermark")
        chunks.observe(counted, F.count(F.lit(1)).alias("chunks")).write.parquet(chunks_path)
        rejected = done.where(~F.col("is_valid_row")).select(
            F.lit(run_id).alias("pipeline_run_id"),
            F.lit(attempt).alias("attempt"),
            F.col("chunk_index").cast("int").alias("chunk_index"),
            "payload",
            "errors",
            F.substring(F.concat_ws("; ", "errors"), 1, V.ERROR_MESSAGE_LIMIT).alias("error_message"),
            F.lit(1).alias("attempt_count"),
            ntz(now).alias("failed_at"),
        )
        # One bulk append, partitioned by run so a per-run report reads one partition
        rejected.withColumn("run", F.lit(run_folder(run_id))).write.mode("append").partitionBy("run").parquet(
            self.ws.dead_letter_path)
        return {"pipeline_run_id": run_id, "dlq_count": checked.get["rejected"], "chunks_validated": counted.get["chunks"]}

    def dead_letters(self) -> DataFrame:
        """The dead-letter table (all runs, all attempts), with its ``run`` partition column."""
        schema = T.StructType(DEAD_LETTER.fields + [T.StructField("run", T.StringType())])
        return read_or_empty(self.spark, self.ws.dead_letter_path, schema)

    def chunk_table(self, run_id: str) -> DataFrame:
        attempt = self._attempt(run_id)
        return self.spark.read.schema(CHUNK_TABLE).parquet(self.ws.buffer("validated_chunks", run_id, attempt))

    # -------------------------------------------------------------- P3
    def load_progress(self, run_id: str) -> DataFrame:
        """Per chunk, the running watermark and completed count the load reaches."""
        st = self.ledger.state(run_id) or {}
        chunks = self.chunk_table(run_id).withColumnRenamed("source_high_watermark", "chunk_high_watermark")
        return L.progress(chunks, st.get("last_watermark") or EPOCH, st.get("chunks_completed") or 0)

    def run_load(self, run_id: str, loaded_at: _dt.datetime) -> dict:
        attempt = self._attempt(run_id)
        if attempt is None or not has_parquet(self.spark, self.ws.buffer("validated_chunks", run_id, attempt)):
            return {"pipeline_run_id": run_id, "records_loaded": 0, "chunks_processed": 0}
        rows = self.spark.read.parquet(self.ws.buffer("validated_rows", run_id, attempt)).where(F.col("is_valid_row"))
        changes = load_projection(rows, loaded_at, carry=("chunk_index", "position"))
        stats = self.chunk_table(run_id).agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("valid_rows"), F.lit(0)).alias("loaded"),
            F.max("source_high_watermark").alias("wm"),
        ).first()
        if stats["loaded"]:
            self.target.upsert(changes, ["chunk_index", "position"], self.config.on_duplicate, self.config.guard)
        if stats["n"]:
            # K7: one event per run: GREATEST(watermark, max chunk watermark), + chunk count.
            self.ledger.append(run_id, "advance", loaded_at, last_watermark=stats["wm"], chunks_delta=int(stats["n"]))
        return {"pipeline_run_id": run_id, "records_loaded": int(stats["loaded"]), "chunks_processed": int(stats["n"])}

    # -------------------------------------------------------------- P4
    def run_metrics(self, run_ids: list[str] | None = None) -> DataFrame:
        current = self.ledger.current()
        offsets = self.ws.read_current("staging_offsets", OFFSETS, current, fmt="json", run_ids=run_ids)
        staging_chunks = offsets.groupBy("pipeline_run_id").agg(
            F.ceil(F.sum("_n") / F.max("chunk_size")).cast("long").alias("staging_chunks"))
        chunks = self.ws.read_current("validated_chunks", CHUNK_TABLE, current, run_ids=run_ids)
        dead = self.dead_letters()
        runs = None
        if run_ids is not None:
            runs = self.spark.createDataFrame([(r,) for r in run_ids], "pipeline_run_id string")
            dead = dead.where(F.col("run").isin([run_folder(r) for r in run_ids]))  # partition pruning
        return P.run_metrics(staging_chunks, chunks, dead, current, runs)

    # -------------------------------------------------------------- P5
    def run_finalize(self, run_id: str, now: _dt.datetime, summary: dict | None = None, status: str = "completed") -> dict:
        # K8, then A8: hide the buffers in the same commit, then delete them.
        self.ledger.append_many(run_id, now, [("finish", {"status": L.check_status(status)}), ("attempt", {"attempt": None})])
        self._attempts[run_id] = None
        self.ws.clear_run(run_id)
        return {"pipeline_run_id": run_id, "status": status, "dlq_count": (summary or {}).get("dlq_count", 0)}

    # -------------------------------------------------------------- P6
    def run_smoke_transfer(self, source: DataFrame, loaded_at: _dt.datetime, limit: int = 1000) -> dict:
        """Newest ``limit`` rows, strict validation, one upsert; no ledger, no dead letter.

        The rows are written once, so what is loaded is what was validated.
        """
        rows = newest_valid_rows(source, self.contract, limit)
        n = rows.count()
        if n == 0:
            return {"rows_read": 0, "rows_loaded": 0}
        self.target.upsert(load_projection(rows, loaded_at), [F.col("updated_at")], "latest")
        return {"rows_read": n, "rows_loaded": n}

    # -------------------------------------------------------------- P7
    def run_pipeline(self, run_id: str, source: DataFrame, now: _dt.datetime, finalize: bool = True,
                     use_watermark: bool = True) -> dict:
        stage = "extract"
        try:
            out = {"extract": self.run_extraction(run_id, source, now, use_watermark)}
            stage = "validate"
            out["validate"] = self.run_validation(run_id, now)
            stage = "load"
            out["load"] = {**self.run_load(run_id, now), "dlq_count": out["validate"]["dlq_count"]}
            stage = "report"
            out["report"] = [r.asDict() for r in self.run_metrics([run_id]).collect()]
            if finalize:
                stage = "finalize"
                out["finalize"] = self.run_finalize(run_id, now, out["validate"])
            return out
        except Exception as exc:
            try:
                self.ledger.append(run_id, "finish", now, status="failed")
            except Exception:  # noqa: BLE001 - keep the original error
                pass
            raise StageError(f"{stage} step failed for run {run_id}: {exc}") from exc

    def table(self) -> DataFrame:
        return self.target.read()

    def late_rows(self, source: DataFrame) -> DataFrame:
        """Source rows at or under the next extract bound that no run loaded or
        rejected. They committed after a run had moved past their time, so no later run
        reads them."""
        since, _, _ = self.resume_point()
        cols = list(self.contract.columns)
        rows = source.select(*cols)
        rejected = self.dead_letters().select(F.from_json("payload", rows.schema, V.PAYLOAD_JSON_OPTIONS).alias("p")).select("p.*")
        return P.late_rows(rows, self.table(), ntz(since), list(self.contract.key), rejected=rejected)
