"""Plan shape checks: pushdown, pruning, no single-task window, bounded broadcasts."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import extract as X
from ledgerline.operators import merge as M
from ledgerline.operators.ranking import tag_sorted
from ledgerline.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermark_filter_and_projection_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "transactions")
    Fixtures(spark, SF).transactions().withColumn("extra", F.lit("x")).write.parquet(path)
    src = spark.read.parquet(path)
    out = X.incremental_extract(src, dt.datetime(1999, 12, 31, 23, 55))
    plan = plan_text(out)
    assert "PushedFilters: [IsNotNull(updated_at), GreaterThan(updated_at," in plan
    assert "extra" not in plan.split("ReadSchema:")[1].split("\n")[0]  # column pruned


def test_chunking_has_no_single_partition_window(spark):
    rows = Fixtures(spark, SF).transactions().select("transaction_id", "updated_at")
    assert "rangepartitioning(updated_at" in plan_text(tag_sorted(rows, X.EXTRACT_ORDER))  # distributed sort
    plan = plan_text(X.assign_chunks(rows, 500))  # reads the checkpointed, tagged rows
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # only the offsets table (one row per sorted partition) is gathered
            assert "HashAggregate(keys=[_part" in lines[i + 1]


def test_dedupe_combines_map_side(spark):
    ev = Fixtures(spark, SF).table("events")
    plan = plan_text(M.latest_per_key(ev, ["user_id"], ["ts", "event_id"]))
    assert "partial_max_by" in plan  # partial aggregation before the shuffle: hot keys stay cheap


def test_cluster_settings_scale():
    from ledgerline.session import cluster_settings

    conf = cluster_settings(100 * 10**12, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) > 300_000
    assert cluster_settings(10**6, 8)["spark.sql.shuffle.partitions"] == "16"


def test_range_rewrite_has_one_exchange(spark, tmp_path):
    """The rewrite of touched ranges shuffles the old rows once (the per-key pick
    reuses the write layout's partitioning)."""
    from ledgerline.schemas import FINANCIAL_RECORDS
    from ledgerline.sources.store import RangeTable

    path = str(tmp_path / "src")
    Fixtures(spark, SF).transactions().withColumn("source_updated_at", F.col("updated_at")) \
        .withColumn("loaded_at", F.col("updated_at")).write.parquet(path)
    old = spark.read.parquet(path)
    latest = old.where(F.col("transaction_id") % 7 == 0).withColumn("status", F.lit("completed"))
    plan = plan_text(RangeTable(spark, str(tmp_path / "t"), FINANCIAL_RECORDS, ["transaction_id"], 100)._merged(old, latest))
    assert plan.count("Exchange ") == 1, plan


def test_upsert_prunes_by_the_join_with_its_changes(spark, tmp_path):
    """Partitions without a change are pruned by Spark, from the join alone."""
    from ledgerline.sources.store import RangeTable

    schema = spark.range(1).withColumn("v", F.lit("a")).schema
    table = RangeTable(spark, str(tmp_path / "t"), schema, ["id"], 100)
    table.upsert(spark.range(1000).withColumn("v", F.lit("a")), ["v"])
    spark.createDataFrame([(205, "x"), (1500, "y")], "id long, v string").write.parquet(str(tmp_path / "c"))
    old = table.touched(spark.read.parquet(str(tmp_path / "c")))
    assert sorted(r["id"] for r in old.collect()) == list(range(200, 300))
    assert "dynamicpruningexpression(" in plan_text(old)


def test_counts_come_out_of_the_writes(spark, root):
    """Row counts are observed by the writes; a run takes few jobs."""
    from ledgerline.plans.pipeline import LedgerPipeline, PipelineConfig

    p = LedgerPipeline(spark, root, PipelineConfig(chunk_size=100))
    source = Fixtures(spark, SF).transactions()
    sc = spark.sparkContext
    sc.setJobGroup("one-run", "one run")
    try:
        out = p.run_pipeline("r1", source, dt.datetime(2024, 1, 1))
    finally:
        sc.setJobGroup("other", "other")
    rows = source.count()
    assert out["extract"]["row_count"] == rows
    assert out["validate"]["dlq_count"] + out["load"]["records_loaded"] == rows
    assert len(sc.statusTracker().getJobIdsForGroup("one-run")) <= 45


def test_newest_rows_push_their_bound_to_the_scan(spark, tmp_path):
    """Ties at the bound, rows without a time, and the pushed filter."""
    from ledgerline.plans.pipeline import newest_rows

    path = str(tmp_path / "t")
    day = lambda i: None if i % 40 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(days=i // 7)
    data = [(i, day(i), "x" * 20) for i in range(400)]
    spark.createDataFrame(data, "id long, updated_at timestamp_ntz, text string").repartition(4).write.parquet(path)
    source = spark.read.parquet(path)
    order = sorted(data, key=lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[0]), reverse=True)
    for limit in (1, 10, 389, 390, 395, 500):
        got = newest_rows(source, limit, "updated_at", "id")
        assert [r["id"] for r in got.collect()] == [r[0] for r in order[:limit]]
        assert ("GreaterThanOrEqual(updated_at," in plan_text(got)) == (limit <= 390)
