"""Operator 10 against exact runs, near passages and clean texts."""

import random

import numpy as np
import pyarrow as pa
from conftest_llm import ODD, words

from ledgerline.llm import passages
from ledgerline.llm.shingles import shingle_hashes


def test_windows_cover_every_run_once():
    h = shingle_hashes(" ".join(words(1, 400)))
    rows = passages.compact_windows(h, 20)
    for lo in range(0, len(h) - 20, 7):
        for hi in range(lo + 19, min(len(h), lo + 90)):
            hit = [c for left, c, right in rows if left <= lo <= c <= hi <= right]
            assert hit == [lo + int(h[lo : hi + 1].argmin())]


def own(i, n=150):
    return words(5000 + i, n, 100_000)


def test_repeated_passages(make):
    rng = random.Random(3)
    p, q, short = words(1, 60), words(2, 80), words(3, 40)
    near = list(q)
    for k in (20, 60):
        near[k] = "changed"
    docs = []
    for i in range(12):
        a = own(i)
        docs.append((i, " ".join(a[:70] + p + a[70:])))
    docs += [(20, " ".join(own(20) + q + own(21))), (21, " ".join(own(22)[:30] + near + own(23)))]
    docs += [(30 + i, " ".join(own(30 + i) + short + own(60 + i))) for i in range(6)]
    docs += [(50, "  \n".join(p).upper())]
    docs += [(60 + i, " ".join(own(90 + i))) for i in range(15)] + [(80, " ".join(own(120)))] * 2
    rng.shuffle(docs)
    got = {r.doc_id: r for r in passages.repeated_passages(make(docs)).collect()}
    assert set(got) == {*range(12), 20, 21, 50}
    for i in range(12):
        assert (got[i].n_passages, got[i].first_doc) == (1, 0)
        start, stop = map(int, got[i].spans.split(":"))
        assert abs(start - 70) <= 5 and abs(stop - 130) <= 5
    # up to the second edit 51 of 61 shingles are common; with it, 66 of 86 would be too few
    assert got[21].first_doc == 20 and got[20].n_words == got[21].n_words == 60


def test_copies_and_hot_line(make):
    line = words(9, 12)
    docs = [(i, " ".join(line + own(i, 100))) for i in range(80)]
    docs += [(200 + i, " ".join(words(7, 300))) for i in range(60)]
    got = passages.repeated_passages(make(docs)).collect()
    assert {r.doc_id for r in got} == set(range(200, 260))
    assert all(r.n_words == 300 and r.first_doc == 200 for r in got)


def test_odd_rows(make):
    docs = make([*ODD, (9, " ".join(words(1, 30_000))), (11, " ".join(["same"] * 500)), (12, " ".join(["same"] * 400))])
    got = {r.doc_id: r.n_words for r in passages.repeated_passages(docs).collect()}
    assert {7, 9} <= set(got) and got[7] == 30_000
    assert not set(got) & {1, 2, 3, 4, 5, 6, 8}
    assert passages.repeated_passages(docs.limit(0)).count() == 0


def test_bound_of_common_positions():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = rng.integers(0, 1 << 24, 90).astype(np.int32)
        b = a.copy()
        b[rng.random(90) < rng.uniform(0, 0.4)] = -1 - np.arange(90)[: int(1)]
        got = passages.common_passage(a, b)
        if got:
            assert np.isin(a, b).sum() >= passages.LEAST_COMMON


def test_windows_beyond_the_first_of_a_key(make):
    # ten documents hold all short pieces of p and not p; document 20 holds those of q before q itself
    p, q = words(31, 60), words(32, 60)
    pieces = lambda x, seed: [w for i in range(0, 60, 6) for w in x[i : i + 10] + own(seed + i, 8)]
    docs = [(i, " ".join(pieces(p, 1000 + 100 * i))) for i in range(10)]
    docs += [(11, " ".join(own(40) + p + own(41))), (12, " ".join(own(42) + p + own(43)))]
    docs += [(20, " ".join([w for i in range(10) for w in pieces(q, 3000 + 100 * i)] + own(44) + q)), (21, " ".join(own(46) + q + own(47)))]
    got = {r.doc_id: r for r in passages.repeated_passages(make(docs)).collect()}
    assert {(d, r.first_doc, r.n_words) for d, r in got.items()} == {(11, 11, 60), (12, 11, 60), (20, 20, 60), (21, 20, 60)}


def test_open_windows_meet_settled_ones():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 23, 100).astype(np.int32)
    near = a.copy()
    near[91:] = 1
    seqs = [np.stack([x & 255, x >> 8 & 255, x >> 16], 1).astype(np.uint8).tobytes() for x in (a, a, near)]
    ints = lambda n: pa.array([n] * 3, pa.int32())
    table = pa.table({"doc": [1, 2, 3], "left": ints(0), "centre": ints(50), "open": [False, False, True], "seq": seqs})
    got = passages._meet(table)
    assert set(zip(got["doc"].to_pylist(), got["other"].to_pylist(), strict=True)) == {(1, 3), (3, 1)}


def best_of(a, b):
    """Length of the longest in-order near stretch, by all starts and ends on common shingles."""
    best = 0
    inside_a, inside_b = np.isin(a, b), np.isin(b, a)
    for lo in np.flatnonzero(inside_a):
        for hi in np.flatnonzero(inside_a)[::-1] + 1:
            if hi - lo < max(passages.T, best + 1):
                break
            p, q = (int(np.flatnonzero(b == a[k])[0]) for k in (lo, hi - 1))
            if q + 1 - p >= passages.T and inside_b[p] and passages._near(a[lo:hi], b[p : q + 1]):
                best = int(hi - lo)
                break
    return best


def test_one_sided_changes_against_brute_force():
    rng = np.random.default_rng(2)
    found = 0
    for case in range(120):
        n = int(rng.integers(55, 110))
        a = rng.permutation(1 << 16)[:n].astype(np.int32)
        b = a.copy()
        for _ in range(int(rng.integers(1, 4))):
            at, k = int(rng.integers(5, len(b) - 5)), int(rng.integers(1, 16))
            new = (1 << 16) + rng.permutation(1 << 16)[:k].astype(np.int32)
            b = np.concatenate((b[:at], new, b[at:])) if case % 2 else np.concatenate((b[:at], b[at + k :]))
        want = max(best_of(a, b), best_of(b, a))
        common = np.flatnonzero(np.isin(a, b))
        i = int(common[len(common) // 2])
        got = passages.common_passage(a, b, i, int(np.flatnonzero(b == a[i])[0]))
        assert (got is None) == (want == 0)
        if got:
            assert max(got[1] - got[0], got[3] - got[2]) == want
            found += 1
    assert found > 60


def test_words_put_into_a_passage(make):
    p, q = words(51, 100), words(52, 60)
    docs = [(1, " ".join(own(80) + p + own(81))), (2, " ".join(own(82) + p[:50] + words(53, 14, 90_000) + p[50:] + own(83)))]
    docs += [(3, " ".join(own(84) + q + own(85))), (4, " ".join(own(86) + q[:30] + words(54, 5, 90_000) + q[30:] + own(87)))]
    got = {r.doc_id: r.n_words for r in passages.repeated_passages(make(docs)).collect()}
    assert got == {1: 100, 2: 114, 3: 60, 4: 65}


def test_bound_of_dense_slices():
    few = passages.DENSE_COMMON - 1
    assert all(100 * (few * (n // passages.DENSE) + min(n % passages.DENSE, few)) < passages.PERCENT * n for n in range(passages.T, 5000))


def test_common_phrases_keep_no_windows(make):
    # every document holds the line and an own loop; only the last two hold a passage
    line, p = words(61, 14), words(62, 60)
    docs = [(i, " ".join(own(200 + i, 60) + line + own(230 + i, 60) + own(300 + i, 3) * 30)) for i in range(20)]
    docs += [(i, " ".join(own(260 + i, 60) + line + p + own(280 + i, 60))) for i in (20, 21)]
    assert {r.doc for r in passages.contents(make(docs)).collect()} == {20, 21}
    assert {r.doc_id for r in passages.repeated_passages(make(docs)).collect()} == {20, 21}


def test_windows_that_may_match_are_those_of_a_passage():
    rng = np.random.default_rng(4)
    for _ in range(100):
        shared = rng.random(200) < rng.uniform(0.5, 1)
        windows = passages.compact_windows(rng.integers(0, 1 << 60, 200).astype(np.uint64))
        ok = passages.may_match(shared, windows)
        for (lo, centre, hi), kept in zip(windows.tolist(), ok.tolist(), strict=True):
            own = shared[lo : hi + 1]
            dense = any(own[k : k + passages.DENSE].sum() >= passages.DENSE_COMMON for k in range(len(own) - passages.DENSE + 1))
            assert kept == (shared[centre] and own.sum() >= passages.LEAST_COMMON and dense)


def test_looped_texts_meet_once_per_run(monkeypatch):
    # 100 nested windows of a loop are one; its chains are tried once per run, not once per pair of centres
    rng = np.random.default_rng(5)
    loop, chains = rng.integers(1, 1 << 23, 3), [0]
    texts = [np.concatenate((rng.integers(1, 1 << 23, 30), np.repeat([loop], 12, 0).ravel(), rng.integers(1, 1 << 23, 30))).astype(np.int32) for _ in range(2)]
    seqs = [np.stack([x & 255, x >> 8 & 255, x >> 16], 1).astype(np.uint8).tobytes() for x in texts]
    centres = [list(range(30, 66, 3))] * 2
    monkeypatch.setattr(passages, "_in_order", lambda *a, f=passages._in_order: chains.__setitem__(0, chains[0] + 1) or f(*a))
    table = pa.table({"doc": [1, 2], "left": pa.array([0, 0], pa.int32()), "centre": centres, "open": [[True] * 12] * 2, "seq": seqs})
    assert passages._meet(table) is None and chains[0] == 0


def test_centres_in_a_stretch_by_all_stretches():
    rng = np.random.default_rng(6)
    for _ in range(100):
        common = rng.random(rng.integers(1, 120)) < rng.uniform(0.7, 0.95)
        want = np.zeros(len(common), bool)
        for a in range(len(common)):
            for b in range(a + passages.T, len(common) + 1):
                want[a:b] |= 5 * common[a:b].sum() >= 4 * (b - a)
        assert (passages._reached(common, np.arange(len(common))) == want).all()


def test_longest_stretch_of_a_long_chain():
    # 600 runs of ten and one other, a loop, many others and a last run: up to the last run too few are common as sets
    ids = iter(range(1, 1 << 20))
    a, b = [], []
    for _ in range(600):
        run = [next(ids) for _ in range(10)]
        a += [*run, next(ids)]
        b += [*run, next(ids)]
    loop, last = [next(ids), next(ids)] * 2000, [next(ids) for _ in range(10)]
    whole = len(a) + len(loop)
    a, b = (np.array(x + loop + [next(ids) for _ in range(600)] + last, np.int32) for x in (a, b))
    assert passages.common_passage(a, b) == (0, whole, 0, whole)


def test_all_ends_of_a_chain_against_one_by_one(monkeypatch):
    rng = np.random.default_rng(7)
    found = 0
    for case in range(150):
        # few values, so that shingles repeat; b is a with changes, a loop or another order
        a = rng.integers(0, int(rng.integers(20, 400)), int(rng.integers(60, 200))).astype(np.int32)
        b = np.concatenate((a[:40], a[int(rng.integers(30, 50)) :]))
        b[rng.random(len(b)) < rng.uniform(0, 0.2)] = 500 + case
        if case % 3 == 0:
            a, b = np.tile(a[:50], 3), np.tile(b[:50], 3)
        a, b = passages._small(a, b)
        pair = passages.Pair(a, b, (np.isin(a, b), np.isin(b, a)), (passages._before(a), passages._before(b)))
        both = [(i, j) for i in range(0, len(a), 7) for j in np.flatnonzero(b == a[i]).tolist()]
        for i, j in both[:12]:
            runs, want = pair.runs(i, j).tolist(), (0, None)
            for k, (lo, p, _) in enumerate(runs):
                for hi, q, n in runs[k:]:
                    hi, q, common = hi + n, q + n, sum(r[2] for r in runs if lo <= r[0] < hi + n)
                    if hi - lo + q - p > want[0] and passages.OTHERS_OF_BOTH * (hi - lo + q - p - 2 * common) <= common and passages._near(a[lo:hi], b[p:q]):
                        want = hi - lo + q - p, (lo, hi, p, q)
            monkeypatch.setattr(passages, "RUNS", [1, 4, 512][case % 3])
            pair.tried.clear()
            pair.unlike.clear()
            assert passages._in_order(pair, i, j) == want[1]
            if want[1]:
                assert pair.may_hold() and pair.may_follow
                found += 1
            # the same runs without the short way for the same order of both sides
            steps = passages.Pair(a, b, pair.flags, pair.before)
            steps.aligned = False
            assert steps.runs(i, j).tolist() == runs
    assert found > 100


def test_bound_of_distinct_others():
    rng = np.random.default_rng(8)
    for _ in range(100):
        x = rng.integers(0, 60, int(rng.integers(passages.T, 150)))
        common = np.isin(x, rng.integers(0, 60, 40))
        want = min(len({*x[k : k + passages.T][~common[k : k + passages.T]].tolist()}) for k in range(len(x) - passages.T + 1))
        assert passages._least_others(common, passages._before(x)) == want
        shares = [(n - c) / c if (c := int(common[k : k + n].sum())) else np.inf for n in range(passages.T, len(x) + 1) for k in range(len(x) - n + 1)]
        assert passages._least_share(common) == min(shares)


def test_unlike_loops_are_given_up(monkeypatch):
    # five in 31 of each loop are its own: no chain can hold a passage, though each side alone has few others
    rng = np.random.default_rng(9)
    shared = rng.permutation(1 << 20)[:26].astype(np.int32)
    x, y = (np.tile(np.concatenate((shared, (1 << 21) + 100 * k + np.arange(5, dtype=np.int32))), 30) for k in (0, 1))
    chains = [0]
    monkeypatch.setattr(passages, "_in_order", lambda *a, f=passages._in_order: chains.__setitem__(0, chains[0] + 1) or f(*a))
    at = np.arange(0, len(x), 31)
    matches = np.array([(0, i, len(x) - 1, 0, j, len(y) - 1) for i in at for j in at])
    assert list(passages.passages_of(x, y, matches)) == [] and chains[0] <= 1


def test_rows_of_a_key_grow_with_its_windows():
    # 40 near copies, all open: pairs are merged to one range of each document, with the least of its others
    rng = np.random.default_rng(10)
    a = rng.integers(1, 1 << 23, 120)
    texts = [np.concatenate((a, rng.integers(1, 1 << 23, 5))) for _ in range(40)]
    seqs = [np.stack([x & 255, x >> 8 & 255, x >> 16], 1).astype(np.uint8).tobytes() for x in texts]
    ints = lambda n: pa.array([n] * 40, pa.int32())
    table = pa.table({"doc": list(range(1, 41)), "left": ints(3), "centre": ints(50), "open": [True] * 40, "seq": seqs})
    got = passages._meet(table)
    assert sorted(zip(*(got[c].to_pylist() for c in ("doc", "other", "start", "stop")), strict=True)) == [(d, 1 + (d == 1), 3, 127) for d in range(1, 41)]


def test_merged_ranges_and_least_others():
    rng = np.random.default_rng(11)
    for _ in range(50):
        start = rng.integers(0, 60, 30)
        found = np.stack((rng.integers(0, 3, 30), rng.integers(5, 9, 30), start, start + rng.integers(1, 9, 30)), axis=1)
        got = {d: [] for d in set(found[:, 0].tolist())}
        for d, o, a, b in zip(*(passages._merged(found)[c].to_pylist() for c in ("doc", "other", "start", "stop")), strict=True):
            assert o == found[found[:, 0] == d, 1].min()
            got[d].append((a, b))
        for d, spans in got.items():
            want = []
            for a, b in sorted(found[found[:, 0] == d, 2:].tolist()):
                if want and a <= want[-1][1]:
                    want[-1] = (want[-1][0], max(want[-1][1], b))
                else:
                    want.append((a, b))
            assert spans == want
