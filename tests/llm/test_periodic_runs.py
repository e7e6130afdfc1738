"""Operator 12 against a search over every period of every document."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest_llm import ODD, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import periodic_runs as pr


def plain_runs(x):
    """Every period in turn: stretches of equal words at that distance, smallest period kept."""
    n, out = len(x), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(12, 2 * q) and not any(a <= s and e <= a + m for a, m, d in out if d < q):
                out.append((s, e - s, q))
            i = j
    return sorted(out)


def runs(x):
    return pr.find_runs([np.array(x, np.int64)])[0]


def check(x):
    assert runs(x) == plain_runs(x)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), max_size=3))
def test_small_alphabets(xs):
    assert pr.find_runs([pr.word_ids(x) for x in xs]) == [plain_runs(x) for x in xs]


def test_planted_runs():
    rnd = random.Random(3)
    for _ in range(300):
        x = []
        while len(x) < rnd.randint(20, 400):
            unit = [rnd.randint(0, rnd.choice([1, 3, 50])) for _ in range(rnd.randint(1, 40))]
            times = rnd.choice([1, 1, 2, 3, 8])
            x += (unit * (times + 1))[: len(unit) * times + rnd.randint(0, len(unit))]
        check(x)


@pytest.mark.parametrize("n", [12, 13, 100, 1000, 4097])
def test_one_word_repeated(n):
    assert runs(np.zeros(n, np.int64)) == [(0, n, 1)]


def test_fibonacci_and_nested_words():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    check(b)
    inner = ([1, 2, 3] * 5 + [4]) * 6
    check(inner)
    check([7, 8] + inner + inner[:20] + [9] + inner)


def test_grammar_derives_the_sequence():
    rnd = np.random.default_rng(5)
    x = np.concatenate([rnd.integers(0, 30, 500), np.tile(rnd.integers(0, 30, 37), 20), rnd.integers(0, 30, 500)])
    g = pr.Grammar(x)
    for symbol, place in zip(g.symbols.tolist(), g.places.tolist(), strict=True):
        size = g.right[symbol] - g.left[symbol]
        assert (x[place : place + size] == x[g.left[symbol] : g.right[symbol]]).all()
    assert len(g.top) < len(x) and len(g.left) < len(x)


def test_long_sequences_are_quick():
    rnd = np.random.default_rng(1)
    long = np.concatenate([rnd.integers(0, 50_000, 200_000), np.tile(rnd.integers(0, 50_000, 700), 300), np.zeros(100_000, np.int64)])
    got = runs(long)
    assert (200_000, 210_000, 700) in got and (410_000, 100_000, 1) in got


def plain_row(doc, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc is not None and n and zlib.crc32(str(doc).encode()) % 10 == 0:
        g = zlib.crc32(str(doc).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    index = {}
    runs = plain_runs([index.setdefault(v, len(index)) for v in w])
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(((-m, s, q) for s, m, q in runs), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    text = " ".join(v for i, v in enumerate(w) if i not in gone)
    return (doc, len(runs), *top, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(text))


def test_query_rows(make):
    line = " ".join(words(2, 9))
    rows = [r for r in ODD if r[0] != 7] + [(20 + i, " ".join(words(i, 30 + i, 40))) for i in range(60)]
    rows += [(100, "\n".join([line] * 4)), (101, "x " * 500), (102, "a\tb\x0bc " * 40 + "\xa0d\x85 " * 20)]
    docs = make(rows).withColumns({c: F.lit(1) for c in ("runs", "start", "n_words", "best", "length")})
    got = pr.run_digests(docs, pr.looped)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(plain_row(d, t)) for d, t in rows)


def test_real_outputs(make):
    docs = make([(1, "a b c " * 5 + "d"), (2, None)])
    got = {r.doc_id: r for r in pr.periodic_runs(docs).collect()}
    assert got[1].collapsed == "a b c d" and [tuple(r) for r in got[1].runs] == [(0, 15, 3)] and got[1].n_words == 16
    assert got[2].collapsed == "" and got[2].runs == [] and got[2].n_words == 0


def test_empty_table(make):
    assert pr.run_digests(make([]).limit(0), pr.looped).collect() == []
