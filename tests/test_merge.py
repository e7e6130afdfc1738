"""Upsert semantics (M1, M4, M7, T12, T13) and the partitioned table."""

import datetime as dt
import glob
from decimal import Decimal

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from ledgerline.operators import merge as M
from ledgerline.schemas import FINANCIAL_RECORDS
from ledgerline.sources.store import LayoutError, RangeTable, finish_replace, merge_into, replace_partitions

T = dt.datetime(2024, 1, 1)
UUID = "123e4567-e89b-12d3-a456-426614174000"


def rec(i, amount, upd, loaded=T):
    return (i, UUID, 1, Decimal(amount), "USD", "debit", "pending", None, T, upd, upd, loaded)


def records(spark, root, width=None):
    return RangeTable(spark, root + "/fr", FINANCIAL_RECORDS, ["transaction_id"], width)


def test_upsert_pair_then_read(spark, root):
    """The reference's manual smoke: insert 100.00, upsert 200.50 on the key, read 200.50."""
    table = records(spark, root)
    table.upsert(spark.createDataFrame([rec(7, "100.00", T)], FINANCIAL_RECORDS), [F.col("updated_at")])
    table.upsert(spark.createDataFrame([rec(7, "200.50", T)], FINANCIAL_RECORDS), [F.col("updated_at")])
    rows = table.read().collect()
    assert [(r["transaction_id"], r["amount"]) for r in rows] == [(7, Decimal("200.50"))]


def test_stale_change_wins_without_guard(spark):
    target = spark.createDataFrame([(1, T + dt.timedelta(days=1), "new")], "k long, ts timestamp_ntz, v string")
    changes = spark.createDataFrame([(1, T, "old")], "k long, ts timestamp_ntz, v string")
    assert M.upsert(target, changes, ["k"], ["ts"]).first()["v"] == "old"  # T12
    assert M.upsert(target, changes, ["k"], ["ts"], guard="ts").first()["v"] == "new"


def test_duplicates_in_one_change_set(spark):
    target = spark.createDataFrame([], "k long, chunk int, pos long, v string")
    changes = spark.createDataFrame([(1, 0, 1, "a"), (1, 1, 7, "b"), (2, 0, 2, "c")], "k long, chunk int, pos long, v string")
    got = {r["k"]: r["v"] for r in M.upsert(target, changes, ["k"], ["chunk", "pos"]).collect()}
    assert got == {1: "b", 2: "c"}  # T13: the later chunk wins
    with pytest.raises(M.DuplicateKeyError):
        M.upsert(target, changes, ["k"], on_duplicate="fail").collect()


def test_outcome_and_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, name string")
    changes = spark.createDataFrame([(2, "b"), (3, "c")], "k long, name string")
    out = {r["k"]: r["outcome"] for r in M.upsert_outcome(target, changes, ["k"]).collect()}
    assert out == {1: "keep", 2: "update", 3: "insert"}
    merged = M.insert_if_absent(target, spark.createDataFrame([(9, "a"), (3, "c")], "k long, name string"), ["name"])
    assert sorted(r["k"] for r in merged.collect()) == [1, 2, 3]


def test_replay_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    changes = spark.createDataFrame([(2, "x"), (3, "y")], "k long, v string")
    once = M.upsert(target, changes, ["k"], ["v"])
    twice = M.upsert(once, changes, ["k"], ["v"])
    assert sorted(once.collect()) == sorted(twice.collect())


def files(table):
    """Data files by range."""
    out = {}
    for f in glob.glob(f"{table.path}/keys_*/*.parquet"):
        out.setdefault(int(f.split("/")[-2].split("=")[1]), []).append(f)
    return {k: sorted(v) for k, v in out.items()}


def amounts(table):
    return {r["transaction_id"]: str(r["amount"]) for r in table.read().collect()}


def upsert(spark, table, recs, **options):
    table.upsert(spark.createDataFrame(recs, FINANCIAL_RECORDS), [F.col("updated_at")], **options)


def test_upsert_rewrites_touched_ranges_only(spark, root):
    table = records(spark, root, 100)
    upsert(spark, table, [rec(i, "1.00", T) for i in range(1, 1001)])
    before = files(table)
    assert sorted(before) == list(range(11))  # ids 1..1000
    upsert(spark, table, [rec(i, "2.00", T) for i in range(1001, 1151)] + [rec(999, "3.00", T)])
    after = files(table)
    assert sorted(k for k in after if after[k] != before.get(k)) == [9, 10, 11]
    got = amounts(table)
    assert len(got) == table.read().count() == 1150 and got[999] == "3.00" and got[1] == "1.00" and got[1150] == "2.00"


def test_other_ranges_are_not_read(spark, root):
    """The upsert works although the files it has no business with cannot be read."""
    table = records(spark, root, 100)
    upsert(spark, table, [rec(i, "1.00", T) for i in range(-150, 500)])
    for k, names in files(table).items():
        for name in names if k not in (2, -2) else []:
            with open(name, "wb") as f:
                f.write(b"not parquet")
    changes = f"{root}/changes"  # a written table, as in the pipeline
    spark.createDataFrame([rec(250, "2.00", T), rec(-120, "3.00", T), rec(900, "4.00", T)], FINANCIAL_RECORDS).write.parquet(changes)
    table.upsert(spark.read.parquet(changes), [F.col("updated_at")])
    got = {}
    for k in (2, -2, 9):
        got.update({r["transaction_id"]: str(r["amount"]) for r in spark.read.parquet(f"{table.path}/keys_100={k}").collect()})
    assert len(got) == 100 + 50 + 1 and (got[250], got[-120], got[900], got[251]) == ("2.00", "3.00", "4.00", "1.00")


def test_large_keys_stay_exact(spark, root):
    table = records(spark, root, 10)
    keys = [2**53 + i for i in range(25)] + [2**62 + 9, 2**62 + 10, -(2**62) - 1, 0, -1]
    upsert(spark, table, [rec(k, "1.00", T) for k in keys])
    assert sorted(files(table)) == sorted({k // 10 for k in keys})
    upsert(spark, table, [rec(k, "2.00", T) for k in keys])
    assert amounts(table) == dict.fromkeys(keys, "2.00") and table.read().count() == len(keys)


@pytest.mark.parametrize("stop", ["copying", "publishing"])
def test_writer_that_dies_leaves_a_whole_table(spark, root, stop, monkeypatch):
    table = records(spark, root, 100)
    upsert(spark, table, [rec(i, "1.00", T) for i in range(1, 301)])
    from ledgerline.sources import store

    if stop == "copying":  # the copy beside the table is not complete
        monkeypatch.setattr(store, "finish_replace", lambda *a, **k: None)
        upsert(spark, table, [rec(5, "9.00", T)])
        import os

        os.remove(f"{table.path}_waiting/_SUCCESS")
        want = "1.00"
    else:  # the copy is complete; the overwrite has taken an old range away
        monkeypatch.setattr(store, "finish_replace", lambda *a, **k: None)
        upsert(spark, table, [rec(5, "9.00", T)])
        store.delete_path(spark, f"{table.path}/keys_100=0")
        want = "9.00"
    monkeypatch.undo()
    again = records(spark, root)  # a new process
    got = amounts(again)
    assert len(got) == 300 and got[5] == want and got[6] == "1.00"
    upsert(spark, again, [rec(5, "9.00", T)])  # the replay
    assert amounts(again)[5] == "9.00" and again.read().count() == 300


def test_width_is_in_the_folder_names_and_a_mismatch_refused(spark, root):
    upsert(spark, records(spark, root, 50), [rec(i, "1.00", T) for i in range(1, 101)])
    with pytest.raises(LayoutError):
        records(spark, root, 10)
    again = records(spark, root)
    assert again.width == 50
    upsert(spark, again, [rec(i, "2.00", T) for i in (5, 101, 102)])
    got = amounts(again)
    assert again.read().count() == len(got) == 102 and got[5] == "2.00"
    for key in (["account_id"], ["transaction_id", "account_id"]):
        with pytest.raises(ValueError):
            RangeTable(spark, root + "/other", FINANCIAL_RECORDS, key)


def test_guard_and_duplicates(spark, root):
    table = records(spark, root, 50)
    day = dt.timedelta(days=1)
    upsert(spark, table, [rec(1, "1.00", T + day), rec(2, "1.00", T)])
    upsert(spark, table, [rec(1, "2.00", T), rec(2, "2.00", T + day), rec(2, "3.00", T + 2 * day)], guard="updated_at")
    assert amounts(table) == {1: "1.00", 2: "3.00"}
    with pytest.raises(M.DuplicateKeyError):
        upsert(spark, table, [rec(2, "4.00", T), rec(2, "5.00", T)], on_duplicate="fail")
    upsert(spark, table, [])  # no change at all
    assert amounts(table) == {1: "1.00", 2: "3.00"}


def test_partitions_of_another_format_are_replaced(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 1)], "k long, v string, day int")
    rows.write.partitionBy("day").json(path)
    replace_partitions(spark.createDataFrame([(9, "z", 0)], rows.schema), path, "day", "json")
    finish_replace(spark, path, rows.schema, "day", "json")  # nothing waits
    assert sorted(r["k"] for r in spark.read.schema(rows.schema).json(path).collect()) == [3, 9]


def test_merge_into_needs_a_catalog_with_row_level_operations(spark, tmp_path):
    spark.sql(f"create table plain_target (k long, v string) using parquet location '{tmp_path}/t'")
    try:
        changes = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
        with pytest.raises(UnsupportedOperationException):
            merge_into(changes, "plain_target", ["k"], ["v"])
    finally:
        spark.sql("drop table plain_target")
