"""References against a large table, by a map of its keys and an exact look-up."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import constraints as K


@pytest.mark.parametrize("bits", [K.MAP_BITS, 1 << 15, 8])
def test_same_rows_as_the_plain_anti_join(spark, bits):
    """Few bits make every row a collision; the result stays exact."""
    ref = spark.range(0, 3000, 3).selectExpr("id as k", "concat('p', id % 7) as s")
    hot = spark.range(400).selectExpr("id + 100000 as row", "if(id % 2 = 0, 30L, 31L) as fk", "'p2' as t")
    rows = spark.range(2000).selectExpr("id as row", "if(id % 50 = 0, null, id - 100) as fk", "concat('p', id % 9) as t").unionByName(hot)
    rows = rows.withColumns({c: F.lit(1) for c in ("bucket", "bits", "key0", "maybe", "lost")})
    got = K.orphans_of_large(rows, ["fk"], ref, ["k"], bits)
    want = K.orphans(rows, ["fk"], ref, ["k"])
    assert got.columns == rows.columns
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[c] for c in rows.columns) for r in want.collect())
    two = K.orphans_of_large(rows, ["fk", "t"], ref, ["k", "s"], bits)
    assert two.count() == K.orphans(rows, ["fk", "t"], ref, ["k", "s"]).count() > 0


def test_empty_sides_and_types(spark):
    ref, none = spark.range(5).withColumnRenamed("id", "k"), spark.range(0).withColumnRenamed("id", "k")
    rows = spark.range(8).withColumnRenamed("id", "fk")
    assert K.orphans_of_large(rows, ["fk"], none, ["k"]).count() == 8
    assert K.orphans_of_large(rows.limit(0), ["fk"], ref, ["k"]).count() == 0
    with pytest.raises(ValueError, match="types"):
        K.orphans_of_large(rows.selectExpr("cast(fk as int) fk"), ["fk"], ref, ["k"])


def test_child_rows_are_not_shuffled(spark, tmp_path):
    """Only the children's distinct keys pass an exchange: none carries the wide column."""
    path = str(tmp_path / "rows")
    spark.range(60_000).selectExpr("id as row", "if(id % 3 = 0, 7L, id + 150000) as fk", "repeat('x', 50) as wide").write.parquet(path)
    ref = spark.range(200_000).withColumnRenamed("id", "k")
    rows = spark.read.parquet(path)
    out = K.orphans_of_large(rows, ["fk"], ref, ["k"])
    assert out.count() == K.orphans(rows, ["fk"], ref, ["k"]).count() > 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the maps themselves


def test_more_collisions_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(K, "SMALL_ROWS", 3)
    rows = spark.range(500).selectExpr("id as row", "id as fk")
    ref = spark.range(0, 500, 2).withColumnRenamed("id", "k")
    got = K.orphans_of_large(rows, ["fk"], ref, ["k"], 64).collect()
    assert sorted(r["fk"] for r in got) == list(range(1, 500, 2))
