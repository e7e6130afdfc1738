"""Ledger fold and resume cases (FIXTURES section 5; T4-T7, T10, T11, V27)."""

import datetime as dt

import pytest

from ledgerline.plans import ledger as L
from ledgerline.plans.pipeline import LedgerStore

T0 = dt.datetime(2024, 1, 1)


def h(x):
    return T0 + dt.timedelta(hours=x)


def store(spark, root):
    return LedgerStore(spark, root + "/ledger")


def resume(st):
    r = L.resume_point(st.current(), 5).first()
    return r["extract_since"], r["initial_watermark"]


def test_first_run_bound(spark, root):
    st = store(spark, root)
    assert resume(st) == (dt.datetime(1969, 12, 31, 23, 55), dt.datetime(1970, 1, 1))  # T5


def test_failed_run_ahead_is_ignored(spark, root):
    st = store(spark, root)
    st.append("a", "start", h(0), last_watermark=h(10), attempt="a1")
    st.append("a", "finish", h(0), status="completed")
    st.append("b", "start", h(1), last_watermark=h(10), attempt="a2")
    st.append("b", "advance", h(1), last_watermark=h(12), chunks_delta=1)
    assert resume(st)[0] == h(10) - dt.timedelta(minutes=5)  # T4: running run at 12:00 not used


def test_rerun_of_completed_id(spark, root):
    st = store(spark, root)
    st.append("a", "start", h(0), last_watermark=h(10), attempt="a1")
    st.append("a", "finish", h(0), status="completed")
    assert resume(st)[0] == h(10) - dt.timedelta(minutes=5)  # T7: read before the restart
    st.append("a", "start", h(1), last_watermark=dt.datetime(1970, 1, 1), attempt="a2")
    cur = st.state("a")
    assert cur["status"] == "running" and cur["last_watermark"] == h(10)  # T6: watermark kept
    assert resume(st)[0] == dt.datetime(1969, 12, 31, 23, 55)  # no completed run while it runs


def test_load_retried_counts_twice(spark, root):
    st = store(spark, root)
    st.append("a", "start", h(0), last_watermark=h(0), attempt="a1")
    st.append("a", "total", h(0), total_chunks=2)
    st.append("a", "advance", h(0), last_watermark=h(3), chunks_delta=2)
    st.append("a", "advance", h(0), last_watermark=h(2), chunks_delta=2)
    cur = st.state("a")
    assert cur["chunks_completed"] == 4 and cur["total_chunks"] == 2  # T6
    assert cur["last_watermark"] == h(3)  # T10: never goes back


def test_unknown_run_update_changes_nothing(spark, root):
    st = store(spark, root)
    st.append("ghost", "advance", h(0), last_watermark=h(5), chunks_delta=1)
    st.append("ghost", "finish", h(0), status="completed")
    assert st.state("ghost") is None  # T11
    assert resume(st)[0] == dt.datetime(1969, 12, 31, 23, 55)


def test_status_guard():
    with pytest.raises(ValueError):
        L.check_status("done")  # V27
    assert L.check_status("failed") == "failed"


def test_progress_running_max(spark):
    chunks = spark.createDataFrame(
        [(i, T0 + dt.timedelta(minutes=m)) for i, m in enumerate([5, 3, 9, 1, 9, 12, 0])],
        "chunk_index int, chunk_high_watermark timestamp_ntz",
    )
    got = L.progress(chunks, T0 + dt.timedelta(minutes=4), base_completed=2, block=2).orderBy("chunk_index").collect()
    assert [(r["last_watermark"] - T0).seconds // 60 for r in got] == [5, 5, 9, 9, 9, 12, 12]
    assert [r["chunks_completed"] for r in got] == [3, 4, 5, 6, 7, 8, 9]


def test_compaction_keeps_every_run_state(spark, root):
    st = store(spark, root)
    st.append("a", "start", h(0), last_watermark=h(1), attempt="a1")
    st.append("a", "total", h(0), total_chunks=3)
    st.append("a", "advance", h(1), last_watermark=h(4), chunks_delta=2)
    st.append("a", "finish", h(2), status="completed")
    st.append("a", "attempt", h(2), attempt=None)
    st.append("b", "start", h(3), last_watermark=h(4), attempt="a9")
    st.append("ghost", "advance", h(3), last_watermark=h(9), chunks_delta=1)
    before = sorted(tuple(r) for r in st.current().collect())
    upto = st.compact()
    assert upto == 7
    after = sorted(tuple(r) for r in st.current().collect())
    assert after == before
    # events after the snapshot fold on top of it
    st.append("b", "advance", h(5), last_watermark=h(6), chunks_delta=1)
    assert st.state("b")["chunks_completed"] == 1 and st.state("b")["last_watermark"] == h(6)
    assert st.state("a")["status"] == "completed" and st.state("a")["chunks_completed"] == 2
    assert resume(st)[0] == h(4) - dt.timedelta(minutes=5)


def test_ledger_constraints(spark, root):
    """V25 / V27 over the folded ledger: a status outside the set is one violation."""
    from ledgerline.operators.constraints import ledger_constraints, violation_counts

    st = store(spark, root)
    st.append("a", "start", h(0), last_watermark=h(1), attempt="a1")
    st.append("b", "start", h(0), last_watermark=h(1), attempt="a2")
    st.append("b", "finish", h(1), status="done")  # written past the guard of check_status
    got = {r["constraint_name"]: r["violations"] for r in violation_counts(st.current(), ledger_constraints()).collect()}
    assert got == {"pipeline_run_id_not_null": 0, "last_watermark_not_null": 0, "status_not_null": 0, "status_in": 1}
