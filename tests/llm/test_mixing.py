"""Operator 5 against a plain walk over the documents, and its oracle on the given tables."""

import hashlib

from conftest_llm import ODD, words

from ledgerline.llm import mixing


def brute(rows, weights=(1, 2, 3)):
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(len((t or "").split()) for _, t, x in rows if x == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    target, open_ = {}, list(sources)
    left = sum(size.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 3 * size[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = float(3 * size[s])
            left -= 3 * size[s]
            open_.remove(s)
    taken = {}
    for s in sources:
        epochs = int(target[s] // size[s]) if size[s] else 0
        rest = int(target[s]) - epochs * size[s]
        mine = [(hashlib.md5(":".join(str(x) for x in ("mix-1", d, t) if x is not None).encode()).hexdigest(), d, t) for d, t, x in rows if x == s]
        for _, d, t in sorted(mine):
            n = len((t or "").split())
            taken[d] = epochs * n + min(rest, n)
            rest -= min(rest, n)
    return size, target, taken


def test_equals_a_plain_walk(make):
    rows = [(i, " ".join(words(i, 5 + 17 * i % 90)), ["b", "a", "c", "hot", "hot", "hot"][i % 6]) for i in range(300)]
    rows += [(900, "x y", "tiny"), (901, "", "empty"), (902, None, "empty"), (903, "u v w", None)]
    got = mixing.mix(mixing.keyed(make(rows))).collect()
    size, target, taken = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.source_size, r.taken) == (size[r.source], taken[r.doc_id])
        assert abs(r.target - target[r.source]) < 1e-6 and r.taken <= 3 * r.size
    by = {}
    for r in got:
        by[r.source] = by.get(r.source, 0) + r.taken
    assert all(by[s] == int(target[s]) for s in target)


def test_ranges_do_not_change_the_result(make, monkeypatch):
    rows = [(i, " ".join(words(i, 30)), "ab"[i % 7 > 4]) for i in range(200)]
    one = {(r.doc_id, r.taken) for r in mixing.mix(mixing.keyed(make(rows))).collect()}
    monkeypatch.setattr(mixing, "ROWS_A_RANGE", 9)
    assert {(r.doc_id, r.taken) for r in mixing.mix(mixing.keyed(make(rows, 5))).collect()} == one


def test_taken_documents(make):
    rows = [(i, " \n" + "  ".join(words(i, 11 + i % 30)) + " ", "abc"[i % 3]) for i in range(120)]
    docs = make(rows)
    plan = {r.doc_id: r for r in mixing.mix(mixing.keyed(docs)).collect()}
    out = mixing.take(docs)
    assert out.columns == docs.columns
    held, whole = {}, dict((d, t) for d, t, _ in rows)
    for r in out.collect():
        held[r.doc_id] = held.get(r.doc_id, 0) + len(r.text.split())
        assert whole[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert held == {d: r.taken for d, r in plan.items() if r.taken}


def test_odd_rows(make):
    docs = make(ODD)
    got = mixing.mix(mixing.keyed(docs)).collect()
    assert len(got) == len(ODD)
    assert all(r.size == 0 and r.taken == 0 for r in got if r.doc_id in (1, 2, 3))
    assert mixing.take(docs).where("doc_id in (1, 2, 3)").count() == 0
    assert mixing.mix(mixing.keyed(docs.limit(0))).count() == 0 and mixing.take(docs.limit(0)).count() == 0
    only_empty = make([(1, None), (2, "")])
    assert [r.taken for r in mixing.mix(mixing.keyed(only_empty)).collect()] == [0, 0]
