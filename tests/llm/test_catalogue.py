"""The registered queries, their SQL, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ledgerline.llm.common import materialise, read
from ledgerline.llm.oracle import LLM_SQL
from ledgerline.llm.queries import LLM_CATALOGUE

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {x.split("_")[0] + "_" for x in names} and "pipeline" in names


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(LLM_SQL[name]).df()
    got = LLM_CATALOGUE[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    clean = lambda df: sorted(tuple(None if v is None or v != v else v for v in r) for r in df[cols].astype(object).itertuples(index=False))
    assert list(map(repr, clean(got))) == list(map(repr, clean(want)))


@pytest.mark.parametrize("name", sorted(set(LLM_CATALOGUE) - set(LLM_SQL)))
def test_rows(spark, name):
    table = "embeddings" if "vectors" in name else "documents"
    got = LLM_CATALOGUE[name](spark, SF)
    rows = got.count()
    if name.split("_")[0] in ("op7", "op10", "op13"):
        assert rows > 0
    else:
        assert rows == read(spark, SF, table).count()


def test_pipeline_stages(spark):
    docs = read(spark, SF, "documents")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = materialise(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before
        if name == "secrets":
            assert after == before
        if name in ("toxicity", "ngram_join"):
            assert 0 < docs.count() < rows
            rows = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == after
    sums = packed.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in sums) <= 2048
