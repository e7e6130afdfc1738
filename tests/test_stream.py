"""The pipeline as a stream over landed files, one run per micro-batch."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.plans.pipeline import LedgerPipeline, PipelineConfig
from ledgerline.sources import fixtures as FX
from ledgerline.streaming.stream import read_stream, start_upsert_stream, stream_run_id

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 2, 1)


def test_three_batches_then_restart(spark, tmp_path):
    landing = str(tmp_path / "landing")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    for i, (lo, hi) in enumerate([(0, 500), (500, 1000), (1000, 10**9)]):
        orders.where((F.col("o_orderkey") >= lo) & (F.col("o_orderkey") < hi)).coalesce(1).write.parquet(f"{landing}/part{i}")
    root = str(tmp_path / "store")
    pipe = LedgerPipeline(spark, root, PipelineConfig(chunk_size=100))
    stream = FX.transactions_raw(FX.transactions(read_stream(spark, f"{landing}/*", orders.schema, max_files=1)))
    ckpt = str(tmp_path / "ckpt")
    q = start_upsert_stream(spark, stream, pipe, "t", ckpt, now=lambda: NOW, compact_every=2)
    q.awaitTermination()
    assert q.exception() is None
    files = len(pipe.ledger.events().inputFiles())
    assert 1 < files < 3 * 4  # merged to one after batch 1, then one more per commit of batch 2
    states = [pipe.ledger.state(stream_run_id("t", b)) for b in range(3)]
    assert all(s is not None and s["status"] == "completed" for s in states)
    batch = FX.transactions_raw(FX.transactions(orders))
    from ledgerline.operators import rules as R
    from ledgerline.operators import validate as V
    want = V.valid_rows(R.evaluate(batch, R.TRANSACTION_CONTRACT)).select("transaction_id", "amount", "currency")
    got = pipe.table().select("transaction_id", "amount", "currency")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    # a restart with the same checkpoint finds nothing new: no run, no change
    q2 = start_upsert_stream(spark, stream, pipe, "t", ckpt, now=lambda: NOW)
    q2.awaitTermination()
    assert pipe.ledger.state(stream_run_id("t", 3)) is None
    assert pipe.table().count() == want.count()


def test_late_rows_are_kept_apart_and_a_restart_changes_nothing(spark, tmp_path):
    """K3, K4: rows behind the watermark go to the late rows; the others are loaded."""
    import time

    from ledgerline.streaming import stream as ST
    from ledgerline.streaming.event_time import mark_late, streaming_session

    own = streaming_session(spark)
    schema = spark.read.parquet(f"{SF}/orders.parquet").schema
    orders = FX.transactions(spark.read.parquet(f"{SF}/orders.parquet").limit(60)).orderBy("updated_at").collect()
    files = [orders[20:40], orders[:10] + orders[40:60], orders[10:20] + orders[20:25]]
    landing = str(tmp_path / "landing")
    types = FX.transactions(spark.createDataFrame([], schema)).schema
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, types).coalesce(1).write.parquet(f"{landing}/f{i}")
        time.sleep(0.05)
    stream = mark_late(read_stream(own, f"{landing}/*", types, max_files=1), ["transaction_id"], "updated_at", "10 days")
    pipe = LedgerPipeline(own, str(tmp_path / "store"), PipelineConfig(chunk_size=100))
    ckpt = str(tmp_path / "ckpt")
    for _ in range(2):  # the second time the checkpoint has all files
        q = start_upsert_stream(own, stream, pipe, "late", ckpt, now=lambda: NOW)
        q.awaitTermination()
        assert q.exception() is None
        newest, want_late, want_loaded = None, [], set()
        for rows in files:
            passed = None if newest is None else newest - dt.timedelta(days=10)
            for r in rows:
                if passed is not None and r["updated_at"] <= passed:
                    want_late.append((r["transaction_id"], r["updated_at"]))
                else:
                    want_loaded.add(r["transaction_id"])
            newest = max([newest or rows[0]["updated_at"], *(r["updated_at"] for r in rows)])
        assert want_late and len(want_loaded) > 30
        assert sorted((r["transaction_id"], r["updated_at"]) for r in ST.late_rows(pipe).collect()) == sorted(want_late)
        assert {r["transaction_id"] for r in pipe.table().collect()} == want_loaded
