"""Operator 4: held-out accuracy, bounds and odd rows."""

import zlib

import numpy as np
from conftest_llm import ODD, words
from pyspark.sql import functions as F

from ledgerline.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=900):
    rng, docs, labels = np.random.default_rng(0), [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = words(i, int(rng.integers(20, 200)), 800)
        for _ in range(int(rng.integers(2, 6)) * toxic):
            w.insert(int(rng.integers(len(w))), ["vilexo", "grubnak", "Snorfle"][int(rng.integers(3))])
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark, make):
    docs, labels = corpus()
    table = make(docs)
    model = toxicity.train(table, spark.createDataFrame(labels, LABELS), toxicity.Sizes(sample=600))
    scored = toxicity.score(table.select("doc_id", "text"), model).collect()
    held = [(r.predicted, labels[r.doc_id][2]) for r in scored if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 150
    assert sum(p == y for p, y in held) >= 0.98 * len(held)
    again = toxicity.train(make(docs, 5), spark.createDataFrame(labels, LABELS).repartition(4), toxicity.Sizes(sample=600))
    assert np.allclose(again.weights, model.weights, atol=1e-5)


def test_held_out_labels_are_not_read(spark, make):
    docs, labels = corpus(300)
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 4 == 2 else t) for d, q, t in labels]
    one = toxicity.train(make(docs), spark.createDataFrame(labels, LABELS))
    two = toxicity.train(make(docs), spark.createDataFrame(flipped, LABELS))
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias


def test_odd_rows(spark, make):
    docs, labels = corpus(200)
    model = toxicity.train(make(docs), spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), (0, 0, 0)], LABELS))
    odd = make(ODD).withColumnRenamed("lang", "score").withColumnRenamed("source", "predicted")
    out = toxicity.score(odd, model)
    rows = out.collect()
    assert len(rows) == len(ODD) and all(0 <= r[5] <= 1 and r[6] in (0, 1) for r in rows)
    assert len({r[5] for r in rows if not r[1]}) == 1
    kept = toxicity.keep(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r[6] == 0 for r in rows)
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_no_labels(spark, make):
    none = toxicity.train(make(ODD), spark.createDataFrame([], LABELS))
    assert none.scores(["a", None]).tolist() == [0.5, 0.5]
    one_class = toxicity.train(make([(i, "text") for i in range(40)]), spark.createDataFrame([(i, 1, 0) for i in range(40)], LABELS))
    assert max(one_class.scores(["text", ""])) < 0.1


def test_long_text_in_parts(monkeypatch):
    sizes, text = toxicity.Sizes(), " ".join(words(1, 4000))
    whole = toxicity.features(text, sizes)
    monkeypatch.setattr(toxicity, "PART_CHARS", 100)
    assert np.array_equal(toxicity.features(text, sizes), whole)


def test_every_labelled_row_is_learnt_from(spark, make):
    """A word that only rows past the size of one fit hold becomes evidence."""
    docs, labels = corpus()
    sizes = toxicity.Sizes(sample=200)
    ids = spark.createDataFrame([(d,) for d, _ in docs], "doc_id long").where(~toxicity.held_out(F.col("doc_id")))
    late = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").collect()[sizes.sample :]]
    docs = [(d, text + " qqzzxxjj" * (d in late and labels[d][2])) for d, text in docs]
    model = toxicity.train(make(docs), spark.createDataFrame(labels, LABELS), sizes)
    assert model.scores(["qqzzxxjj"])[0] > 2 * model.scores(["aabbccdd"])[0]
    held = [(text, labels[d][2]) for d, text in docs if zlib.crc32(str(d).encode()) % 4 == 2]
    scores = model.scores([text for text, _ in held])
    assert sum((s >= toxicity.THRESHOLD) == y for s, (_, y) in zip(scores, held, strict=True)) >= 0.98 * len(held)


def test_rows_that_share_an_id_are_fitted_in_blocks(spark, make):
    docs, labels = corpus(300)
    twice = toxicity.train(make([*docs, *[(5, docs[5][1])] * 500]), spark.createDataFrame(labels, LABELS), toxicity.Sizes(sample=100))
    assert np.isfinite(twice.weights).all() and np.isfinite(twice.bias)
