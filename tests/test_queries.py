"""Every catalogue query against its DuckDB oracle on the smallest test data."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.plans.queries import CATALOGUE

SF = "/root/testdata/sf0.001"

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_ledger_query_is_registered_with_an_oracle():
    # the training-data queries have their own tests, which stand or fall with their folder
    assert set(CATALOGUE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = canon(df.columns, df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    want = canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns[0] == "transaction_id"


def test_bench_prints_one_json_line():
    import json
    import subprocess
    import sys

    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_QUERIES="incremental_extract,resume_point")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d) and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"incremental_extract", "resume_point"}
