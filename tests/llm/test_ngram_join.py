"""Operator 3 against a comparison of all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD, words

from ledgerline.llm import common, ngram_join
from ledgerline.llm.shingles import shingle_hashes


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Component of each doc_id by all pairs."""
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return {(d, low[find(i)], len(sets[i])) for i, (d, _) in enumerate(rows)}


def corpus(seed):
    """Chains of near copies around the threshold, a common passage, copies and small texts."""
    rng, rows = random.Random(seed), []
    passage = words(99, 60)
    for g in range(14):
        base = words(1000 * seed + g, rng.choice([30, 60, 120, 200]))
        for _ in range(rng.randrange(1, 9)):
            rows.append(" ".join(base))
            for _ in range(rng.randrange(0, 5)):
                base = list(base)
                base[rng.randrange(len(base))] = f"edit{rng.random()}"
    rows += [" ".join(passage + words(7000 + i, rng.choice([3, 8, 14, 40]))) for i in range(40)]
    rows += ["one", "ONE", "one two", "a b c d e", "A  b\tc D\ne", "", " \n"]
    rng.shuffle(rows)
    return [(10 + i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block", [None, 8])
def test_components_equal_all_pairs(make, monkeypatch, seed, block):
    if block:  # force tiles, and an order with frequent shingles last
        monkeypatch.setattr(ngram_join, "REGION_BLOCK", block)
        monkeypatch.setattr(ngram_join, "GROUP_BLOCK", 400)
        monkeypatch.setattr(ngram_join, "SAMPLE_ONE_IN", 1)
    rows = corpus(seed)
    got = ngram_join.link(make(rows)).collect()
    assert {(r.doc_id, r.component_id, r.n_shingles) for r in got} == brute(rows)
    assert len(got) == len(rows)


def test_order_does_not_change_links(make):
    rows = corpus(4)
    none = ngram_join.BitMap(np.empty(0, np.int64))
    every = ngram_join.BitMap(np.arange(1 << ngram_join.MAP_BITS))
    for order in (none, every):
        frames = ngram_join.profile(make(rows), order)
        assert frames.count() == len(rows)


def test_odd_rows(make):
    docs = make(ODD)
    rows = ngram_join.link(docs).collect()
    got = sorted((r.doc_id, r.component_id, r.n_shingles) for r in rows if r.doc_id is not None)
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, 1, 0), (2, 2, 0), (3, 3, 0)]
    assert (8, 4, 1) in got and len(rows) == len(ODD)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, d) for d in range(1, 8)] + [(True, 0)]
    assert ngram_join.link(docs.limit(0)).count() == 0


def test_window_bound():
    """Every pair at the threshold shares at least the bound's number of window shingles."""
    rng = random.Random(0)
    for _ in range(300):
        n = rng.randrange(1, 60)
        a = set(rng.sample(range(10_000), n))
        b = set(a)
        while rng.random() < 0.9:
            c = set(b)
            c.add(rng.randrange(10_000)) if rng.random() < 0.5 or len(c) < 2 else c.discard(rng.choice(sorted(c)))
            if 100 * len(a & c) < 80 * len(a | c):
                break
            b = c
        x, y = (set(sorted(s)[: ngram_join.window_size(len(s))]) for s in (a, b))
        assert len(x & y) >= ngram_join.least_common(np.array([len(a)]), np.array([len(b)]))[0]


def test_shingles_ignore_parts(monkeypatch):
    from ledgerline.llm import shingles

    text = " ".join(words(5, 3000)) + " " + "y" * 5000 + " end of it all"
    whole = shingle_hashes(text)
    monkeypatch.setattr(shingles, "_PART", 64)
    assert (shingle_hashes(text) == whole).all()
    assert len(whole) == len(text.split()) - 4


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(500, k) for k in range(501, 900)] + [(k, k + 1) for k in range(1000, 1200)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {n: find(n) for a, b in edges if a != b for n in (a, b)}


def test_map_returns_packed_bytes(spark):
    rng = np.random.default_rng(4)
    hashes = rng.integers(-(1 << 63), 1 << 63, 300_000, dtype=np.int64)
    table = spark.createDataFrame(pa.table({"h": hashes}))
    for size in (16, 20):
        # every slot may be set: the rows that return stay those of the map
        parts = ngram_join.packed_parts(table, size)
        assert parts.count() <= 1 << (size - ngram_join.PART_BITS)
        got = ngram_join.bitmap(table, size)
        slots = np.unique(hashes & ((1 << size) - 1))
        assert np.array_equal(np.flatnonzero(got.has(np.arange(1 << size))), slots)
    assert not ngram_join.bitmap(table.limit(0)).has(hashes).any()


def test_keep_one_with_clashing_columns(make):
    docs = make(ODD).withColumnRenamed("lang", "_keep").withColumnRenamed("source", "_place").withColumnRenamed("n_chars", "keep")
    out = ngram_join.keep_one(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == out.count() and {r["_keep"] for r in rows.values()} == {"en"} and {r["_place"] for r in rows.values()} == {"a"}
