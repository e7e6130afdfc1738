"""The pipeline end to end on small inputs: the DAG fixture shape of the reference's
tests (10 rows, 2 chunks, 1 dead letter, 9 loaded) and the state cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.plans.pipeline import LedgerPipeline, PipelineConfig, StageError
from ledgerline.operators.validate import MalformedRowsError
from ledgerline.schemas import TRANSACTION_COLUMNS

UUID = "123e4567-e89b-12d3-a456-426614174000"
NOW = dt.datetime(2026, 4, 18)
RUN = "manual__2026-04-18T00:00:00+00:00"
T0 = dt.datetime(2026, 4, 17, 12)

SCHEMA = ("transaction_id long, account_id string, category_id int, amount string, currency string, "
          "transaction_type string, status string, description string, created_at timestamp_ntz, updated_at timestamp_ntz")


def rows(spark, n, bad=(), start=1, t0=T0, amount="10.00"):
    data = []
    for i in range(start, start + n):
        ts = t0 + dt.timedelta(minutes=i)
        data.append((i, UUID, 1, amount, "usd", "debit", "PENDING" if i in bad else "pending", None, ts, ts))
    return spark.createDataFrame(data, SCHEMA)


def test_dag_fixture_shape(spark, root):
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    src = rows(spark, 10, bad={4})
    ext = p.run_extraction(RUN, src, NOW)
    assert ext == {"pipeline_run_id": RUN, "chunk_count": 2, "extract_since": "1969-12-31T23:55:00", "row_count": 10}
    assert p.run_validation(RUN, NOW) == {"pipeline_run_id": RUN, "dlq_count": 1, "chunks_validated": 2}
    assert p.run_load(RUN, NOW) == {"pipeline_run_id": RUN, "records_loaded": 9, "chunks_processed": 2}
    rep = p.run_metrics([RUN]).first().asDict()
    assert rep == {"pipeline_run_id": RUN, "staging_chunks": 2, "validated_chunks": 2, "dead_letter_rows": 1,
                   "chunks_completed": 2, "total_chunks": 2, "checkpoint_status": "running"}
    assert p.run_finalize(RUN, NOW, {"dlq_count": 1}) == {"pipeline_run_id": RUN, "status": "completed", "dlq_count": 1}
    after = p.run_metrics([RUN]).first().asDict()
    assert after["staging_chunks"] == 0 and after["validated_chunks"] == 0 and after["dead_letter_rows"] == 1
    target = p.table()
    assert target.count() == 9
    assert target.where(F.col("currency") != "USD").count() == 0  # normalised
    assert p.ledger.state(RUN)["last_watermark"] == T0 + dt.timedelta(minutes=10)  # T8: over raw rows


def test_second_run_resumes_and_rereads_overlap(spark, root):
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    p.run_pipeline("r1", rows(spark, 10, bad={10}), NOW)
    src = rows(spark, 15, bad={10})  # 5 more rows after the first run
    out = p.run_pipeline("r2", src, NOW + dt.timedelta(days=1))
    # bound = 12:10 - 5 min: rows at 12:06..12:15 are re-read (overlap), one bad row again
    assert out["extract"]["row_count"] == 10
    assert out["validate"]["dlq_count"] == 1
    dl = p.run_metrics(["r1", "r2"]).orderBy("pipeline_run_id").collect()
    assert [r["dead_letter_rows"] for r in dl] == [1, 1]  # T16: dead-lettered again
    reloaded = p.table().where(F.col("loaded_at") == NOW + dt.timedelta(days=1)).count()
    assert reloaded == 9  # T15: overlap rows reloaded, loaded_at moves
    assert p.table().count() == 14


def test_boundary_row_is_not_extracted(spark, root):
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5, overlap_minutes=0))
    p.run_pipeline("r1", rows(spark, 3), NOW)
    out = p.run_extraction("r2", rows(spark, 3), NOW)
    assert out["row_count"] == 0 and out["chunk_count"] == 0  # T1: strict '>'


def test_empty_extract_keeps_watermark(spark, root):
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    empty = spark.createDataFrame([], SCHEMA)
    out = p.run_pipeline("r0", empty, NOW)
    assert out["extract"]["chunk_count"] == 0 and out["load"]["records_loaded"] == 0
    st = p.ledger.state("r0")
    assert st["status"] == "completed" and st["last_watermark"] == dt.datetime(1970, 1, 1)


def test_all_rows_invalid_still_advance(spark, root):
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    p.run_pipeline("r1", rows(spark, 5, bad={1, 2, 3, 4, 5}), NOW)
    st = p.ledger.state("r1")
    assert st["chunks_completed"] == 1 and st["last_watermark"] == T0 + dt.timedelta(minutes=5)  # T9
    assert p.table().count() == 0


def test_malformed_row_stops_before_any_write(spark, root):
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    src = rows(spark, 5).withColumn("amount", F.when(F.col("transaction_id") == 3, "abc").otherwise(F.col("amount")))
    with pytest.raises(StageError) as stopped:
        p.run_pipeline("r1", src, NOW)
    cause = stopped.value.__cause__
    assert isinstance(cause, MalformedRowsError) and "position=3: amount_type" in str(cause)
    assert p.ledger.state("r1")["status"] == "failed"  # T21: we record the failure
    m = p.run_metrics(["r1"]).first()
    assert m["dead_letter_rows"] == 0 and m["validated_chunks"] == 0
    q = LedgerPipeline(spark, root + "2", PipelineConfig(chunk_size=5, on_malformed="dead_letter"))
    assert q.run_pipeline("r1", src, NOW)["validate"]["dlq_count"] == 1


def test_smoke_transfer(spark, root):
    p = LedgerPipeline(spark, root, PipelineConfig())
    src = rows(spark, 25).select(*TRANSACTION_COLUMNS)
    assert p.run_smoke_transfer(src, NOW, limit=1000) == {"rows_read": 25, "rows_loaded": 25}
    assert p.run_smoke_transfer(src.limit(0), NOW) == {"rows_read": 0, "rows_loaded": 0}
    with pytest.raises(Exception):
        p.run_smoke_transfer(rows(spark, 3, bad={2}), NOW)  # V19 strict: one bad row stops it


def test_chunk_size_parameter():
    with pytest.raises(ValueError):
        PipelineConfig(chunk_size=0)
    with pytest.raises(ValueError):
        PipelineConfig(overlap_minutes=-1)


def test_rerun_same_id_replaces_buffers(spark, root):
    """Re-running a run id stages a new attempt that replaces the old rows;
    the ledger keeps counting (the reference's counters are never reset)."""
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    p.run_pipeline("r1", rows(spark, 10), NOW, finalize=False)
    first = p.ledger.state("r1")["attempt"]
    out = p.run_pipeline("r1", rows(spark, 10), NOW, finalize=False)
    st = p.ledger.state("r1")
    assert st["attempt"] != first
    assert out["extract"]["row_count"] == 10  # no completed run yet: same bound as before
    m = p.run_metrics(["r1"]).first()
    assert m["staging_chunks"] == 2 and m["validated_chunks"] == 2  # old attempt not counted
    assert st["chunks_completed"] == 4 and st["total_chunks"] == 2
    assert p.table().count() == 10  # replay: same target state


def test_stages_in_separate_processes(spark, root, tmp_path):
    """Each stage through the CLI runner with a fresh pipeline object: state lives in the
    ledger and the storage root only (the reference runs each stage as its own task)."""
    from ledgerline.cli import run

    src = str(tmp_path / "src")
    rows(spark, 10, bad={4}).write.parquet(src)
    common = ["--root", root, "--run-id", RUN, "--chunk-size", "5", "--now", NOW.isoformat()]
    ext = run(["extract", "--source-path", src, *common], spark)
    assert ext["row_count"] == 10 and ext["chunk_count"] == 2
    assert run(["validate", *common], spark)["dlq_count"] == 1
    assert run(["load", *common], spark)["records_loaded"] == 9
    rep = run(["report", *common], spark)
    assert rep["staging_chunks"] == 2 and rep["checkpoint_status"] == "running"
    assert run(["finalize", "--dlq-count", "1", *common], spark)["status"] == "completed"
    nxt = run(["extract", "--source-path", src, *common[:2], "--run-id", "next", "--chunk-size", "5", "--now", NOW.isoformat()],
              spark)
    assert nxt["extract_since"] == "2026-04-17T12:05:00"  # 12:10 minus the overlap


def test_crash_between_table_and_ledger_then_replay(spark, root):
    """The table version is committed but the ledger event is not (the driver dies);
    re-running the run gives the same table and a consistent ledger."""
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    src = rows(spark, 10, bad={3})
    p.run_extraction("r1", src, NOW)
    p.run_validation("r1", NOW)
    real = p.ledger.append_many

    def dies_on_advance(run_id, at, events):
        if events and events[0][0] == "advance":
            raise RuntimeError("driver lost")
        return real(run_id, at, events)

    p.ledger.append_many = dies_on_advance
    with pytest.raises(RuntimeError):
        p.run_load("r1", NOW)
    assert p.table().count() == 9  # the data commit happened
    assert p.ledger.state("r1")["chunks_completed"] == 0  # the ledger commit did not
    q = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))  # a new process
    out = q.run_pipeline("r1", src, NOW)
    assert out["load"]["records_loaded"] == 9
    assert q.table().count() == 9
    st = q.ledger.state("r1")
    assert st["status"] == "completed" and st["chunks_completed"] == 2


def test_json_text_source_normalised_end_to_end(spark, root, tmp_path):
    """A JSON-lines source read with an all-text schema (as staged JSON values arrive):
    lenient UUIDs, padded currency, offset and 'Z' times are normalised on the way in."""
    import json

    from ledgerline.sources.tables import read_source

    recs = [
        {"transaction_id": 1, "account_id": "{" + UUID.upper() + "}", "category_id": "2", "amount": "10.50",
         "currency": " eur ", "transaction_type": "debit", "status": "pending", "description": "  a  ",
         "created_at": "2026-04-17T10:00:00Z", "updated_at": "2026-04-17T12:00:00+02:00"},
        {"transaction_id": 2, "account_id": "urn:uuid:" + UUID, "category_id": 3.0, "amount": 1e3,
         "currency": "usd", "transaction_type": "credit", "status": "completed",
         "created_at": "2026-04-17", "updated_at": "2026-04-17 11:00:00"},
    ]
    path = tmp_path / "src.json"
    path.write_text("\n".join(json.dumps(r) for r in recs))
    schema = ", ".join(f"{c} string" for c in TRANSACTION_COLUMNS)
    src = read_source(spark, "json", str(path), schema=schema)
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    out = p.run_pipeline("json-run", src, NOW)
    assert out["validate"]["dlq_count"] == 0
    got = {r["transaction_id"]: r for r in p.table().collect()}
    assert got[1]["account_id"] == UUID and got[2]["account_id"] == UUID
    assert got[1]["currency"] == "EUR" and got[2]["currency"] == "USD"
    assert got[1]["description"] == "a" and got[2]["description"] is None
    assert got[1]["updated_at"] == dt.datetime(2026, 4, 17, 10, 0)  # +02:00 read as UTC
    assert got[2]["category_id"] == 3 and str(got[2]["amount"]) == "1000.00"
    assert p.ledger.state("json-run")["last_watermark"] == dt.datetime(2026, 4, 17, 11, 0)


def test_dead_letter_report_prunes_partitions(spark, root):
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    p.run_pipeline("r1", rows(spark, 5, bad={2}), NOW)
    p.run_pipeline("r2", rows(spark, 5, bad={8}, start=6), NOW)
    from ledgerline.sources.store import run_folder

    one = p.dead_letters().where(F.col("run").isin([run_folder("r2")]))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan and one.count() == 1
    assert [r["dead_letter_rows"] for r in p.run_metrics(["r1", "r2"]).orderBy("pipeline_run_id").collect()] == [1, 1]


def test_pipeline_chain_and_metadata_keys(spark, root):
    """The stage chain and the keys each stage hands to the next (the reference's DAG
    wiring and metadata tests); the load result also carries ``dlq_count``."""
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    out = p.run_pipeline(RUN, rows(spark, 10, bad={4}), NOW)
    assert list(out) == ["extract", "validate", "load", "report", "finalize"]
    assert set(out["extract"]) == {"pipeline_run_id", "chunk_count", "extract_since", "row_count"}
    assert set(out["validate"]) == {"pipeline_run_id", "dlq_count", "chunks_validated"}
    assert out["load"] == {"pipeline_run_id": RUN, "records_loaded": 9, "chunks_processed": 2, "dlq_count": 1}
    assert set(out["report"][0]) == {"pipeline_run_id", "staging_chunks", "validated_chunks", "dead_letter_rows",
                                     "chunks_completed", "total_chunks", "checkpoint_status"}
    assert out["report"][0]["checkpoint_status"] == "running"  # the report runs before finalize
    assert out["finalize"] == {"pipeline_run_id": RUN, "status": "completed", "dlq_count": 1}


def test_late_rows_report(spark, root):
    """A row that lands after the run, with an old time, is never extracted."""
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    p.run_pipeline("r1", rows(spark, 10), NOW)
    late = rows(spark, 1, start=50, t0=T0 - dt.timedelta(hours=2))  # updated 10:50, lands after the run
    src = rows(spark, 10).unionByName(late)
    assert [r["transaction_id"] for r in p.late_rows(src).collect()] == [50]
    assert p.run_pipeline("r2", src, NOW)["extract"]["row_count"] == 5  # only the overlap
    assert [r["transaction_id"] for r in p.late_rows(src).collect()] == [50]


def test_late_update_and_rejected_row(spark, root):
    """K4: an update that commits late is reported though its key is loaded; a row that a
    run rejected is not."""
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    src = rows(spark, 10, bad={3})
    p.run_pipeline("r1", src, NOW)
    assert p.late_rows(src).count() == 0
    hour = F.expr("interval 1 minute")
    update = src.where("transaction_id = 2").withColumn("updated_at", F.col("updated_at") + hour)
    assert [r["transaction_id"] for r in p.late_rows(src.where("transaction_id <> 2").unionByName(update)).collect()] == [2]


def test_replayed_run_counts_its_rejects_once(spark, root):
    """The report counts the rejects of a run's last attempt; compaction keeps that."""
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    for _ in range(2):
        p.run_pipeline("r1", rows(spark, 6, bad={3}), NOW, use_watermark=False)
    assert p.run_metrics(["r1"]).first()["dead_letter_rows"] == 1
    upto = p.ledger.compact()
    assert p.ledger.compact() == upto  # repeatable
    assert p.run_metrics(["r1"]).first()["dead_letter_rows"] == 1
    p.run_pipeline("r1", rows(spark, 6), NOW, use_watermark=False)  # the replay has no bad row
    assert p.run_metrics(["r1"]).first()["dead_letter_rows"] == 0


def test_retry_without_buffers_gives_zeros(spark, root):
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    p.run_pipeline("r1", rows(spark, 6), NOW)  # finalised: its buffers are gone
    assert p.run_validation("r1", NOW) == {"pipeline_run_id": "r1", "dlq_count": 0, "chunks_validated": 0}
    assert p.run_load("r1", NOW) == {"pipeline_run_id": "r1", "records_loaded": 0, "chunks_processed": 0}
    assert p.run_load("never", NOW)["records_loaded"] == 0


def test_text_times_are_parsed_before_the_filter_and_the_sort(spark, root):
    src = rows(spark, 4).withColumn("updated_at", F.element_at(F.array(
        F.lit("2026-04-17T11:00:00-05:00"), F.lit("2026-04-17T16:30:00Z"), F.lit("20260417T154500"), F.lit("yesterday")), F.col("transaction_id").cast("int")))
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5, on_malformed="dead_letter"))
    p.run_pipeline("r0", rows(spark, 1, start=90, t0=dt.datetime(2026, 4, 17, 10, 30)), NOW)  # watermark 12:00
    out = p.run_pipeline("r1", src, NOW, finalize=False)
    assert (out["extract"]["row_count"], out["validate"]["dlq_count"], out["load"]["records_loaded"]) == (4, 1, 3)
    staged = [r["transaction_id"] for r in p.staging_rows("r1").orderBy("position").collect()]
    assert staged == [4, 3, 1, 2]  # unparsed first, then by instant
    got = {r["transaction_id"]: r["updated_at"] for r in p.table().collect()}
    assert got[1] == dt.datetime(2026, 4, 17, 16) and got[3] == dt.datetime(2026, 4, 17, 15, 45)


def test_load_progress_per_chunk(spark, root):
    """The running watermark and completed count the load reaches, chunk by chunk."""
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=4))
    p.run_extraction("r1", rows(spark, 10), NOW)
    p.run_validation("r1", NOW)
    got = [(r["chunk_index"], r["chunks_completed"], r["last_watermark"]) for r in
           p.load_progress("r1").orderBy("chunk_index").collect()]
    minute = lambda m: T0 + dt.timedelta(minutes=m)
    assert got == [(0, 1, minute(4)), (1, 2, minute(8)), (2, 3, minute(10))]


def test_source_pinned_by_staging(spark, root, tmp_path):
    """The extract has no upper bound, so the staging write pins what the run saw; rows
    landing in the source afterwards wait for the next run."""
    src = str(tmp_path / "src")
    rows(spark, 10).write.parquet(src)
    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5))
    assert p.run_extraction("r1", spark.read.parquet(src), NOW)["row_count"] == 10
    rows(spark, 5, start=11).write.mode("append").parquet(src)  # lands during the run
    p.run_validation("r1", NOW)
    assert p.run_load("r1", NOW)["records_loaded"] == 10
    p.run_finalize("r1", NOW)
    assert p.run_pipeline("r2", spark.read.parquet(src), NOW)["load"]["records_loaded"] == 10  # 5 overlap + 5 new
    assert p.table().count() == 15


def test_cli_smoke_stage(spark, root, tmp_path):
    """P6 through the stage runner: newest rows, strict validation, one upsert."""
    from ledgerline.cli import run

    src = str(tmp_path / "src")
    rows(spark, 25).select(*TRANSACTION_COLUMNS).write.parquet(src)
    out = run(["smoke", "--root", root, "--source-path", src, "--limit", "1000", "--now", NOW.isoformat()],
              spark)
    assert out == {"rows_read": 25, "rows_loaded": 25}
