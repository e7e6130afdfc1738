"""Reconciliation by digests against a full outer join of all rows."""

import random

import pytest

from ledgerline.operators.reconcile import digests, reconcile

SCHEMA = "k long, v string, n int"


def plain(left, right):
    by = lambda rows: {k: sorted((r for r in rows if r[0] == k), key=repr) for k in {r[0] for r in rows}}
    a, b = by(left), by(right)
    out = {}
    for k in a.keys() | b.keys():
        if k not in b:
            out[k] = "missing"
        elif k not in a:
            out[k] = "extra"
        elif a[k] != b[k]:
            out[k] = "changed"
    return out


def outcome(spark, left, right, levels=(64, 8)):
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (left, right)]
    rows = reconcile(*frames, "k", ["v", "n"], levels).collect()
    assert len({r["k"] for r in rows}) == len(rows)
    return {r["k"]: r["outcome"] for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables(spark, seed):
    rnd = random.Random(seed)
    left = [(rnd.randint(-500, 500), rnd.choice(["a", "b", None]), rnd.choice([0, 1, None])) for _ in range(600)]
    right = [r for r in left if rnd.random() > 0.02]
    right = [(k, rnd.choice(["a", "z"]), n) if rnd.random() < 0.02 else (k, v, n) for k, v, n in right]
    right += [(rnd.randint(-600, 600), "new", 1) for _ in range(10)]
    rnd.shuffle(right)
    want = plain(left, right)
    assert want and outcome(spark, left, right) == want


def test_special_cases(spark):
    left = [(None, "a", 1), (2**62, "x", 1), (-1, None, 0), (5, "a", 1), (5, "a", 1), (6, "a", None), (7, "ab", 1)]
    right = [(None, "b", 1), (2**62, "x", 1), (-1, "", 0), (5, "a", 1), (6, "a", 0), (8, "ab", 1)]
    assert outcome(spark, left, right) == plain(left, right)
    assert outcome(spark, left, left[::-1]) == {}
    assert outcome(spark, left, []) == dict.fromkeys({r[0] for r in left}, "missing")
    assert outcome(spark, [], []) == {}


def test_rows_that_swap_values_differ(spark):
    """Sums of hashes see which key holds which value, not only the values."""
    assert outcome(spark, [(1, "a", 0), (2, "b", 0)], [(1, "b", 0), (2, "a", 0)]) == {1: "changed", 2: "changed"}


def test_digests_combine_map_side(spark):
    plan = digests(spark.range(100).selectExpr("id k", "'a' v"), "k", ["k", "v"], 10)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "partial_count" in plan


def test_unlike_types_are_refused(spark):
    with pytest.raises(ValueError, match="n"):
        reconcile(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "k long, v string, n long"), "k", ["v", "n"])
