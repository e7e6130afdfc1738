"""Global position equals a global row_number, including ties and a hot key."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.extract import assign_chunks
from ledgerline.operators.ranking import global_position


def test_position_equals_row_number_with_hot_value(spark):
    # a third of the rows share one timestamp: ties are ordered by the id
    hot = dt.datetime(2024, 1, 1)
    rows = [(i, hot if i % 3 == 0 else hot + dt.timedelta(seconds=(i * 7919) % 5000)) for i in range(1, 6001)]
    df = spark.createDataFrame(rows, "transaction_id long, updated_at timestamp_ntz").repartition(7)
    got = global_position(df, ["updated_at", "transaction_id"])
    want = df.withColumn("position", F.row_number().over(Window.orderBy("updated_at", "transaction_id")))
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == 6000


def test_ties_1200_rows_chunk_500(spark):
    t = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(i, t) for i in range(1, 1201)], "transaction_id long, updated_at timestamp_ntz")
    chunks = assign_chunks(df, 500).groupBy("chunk_index").agg(F.count("*").alias("n"), F.min("transaction_id").alias("lo"))
    assert sorted((r["chunk_index"], r["n"], r["lo"]) for r in chunks.collect()) == [(0, 500, 1), (1, 500, 501), (2, 200, 1001)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "transaction_id long, updated_at timestamp_ntz")
    assert assign_chunks(df, 5).count() == 0


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(times=st.lists(st.integers(min_value=0, max_value=5), min_size=0, max_size=300), parts=st.integers(1, 9))
def test_position_property(spark, times, parts):
    base = dt.datetime(2024, 1, 1)
    rows = [(i + 1, base + dt.timedelta(seconds=t)) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "transaction_id long, updated_at timestamp_ntz").repartition(parts)
    got = sorted((r["transaction_id"], r["position"]) for r in global_position(df, ["updated_at", "transaction_id"]).collect())
    want = sorted((tid, n + 1) for n, (tid, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0]))))
    assert got == want
