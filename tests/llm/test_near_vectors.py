"""Operator 9 against all products."""

import numpy as np
import pytest

from ledgerline.llm import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, links string"


def rows_of(seed):
    rng, rows = np.random.default_rng(seed), []
    for label in (0, 1, None):
        for _ in range(25):
            centre = rng.normal(size=16) * rng.uniform(0.1, 9)
            for _ in range(rng.integers(1, 6)):
                rows.append((centre + rng.normal(size=16) * np.abs(centre).mean() * rng.choice([0, 0.1, 0.15, 0.2, 0.3]), label))
    rows += [(rng.normal(size=8), 0), (np.zeros(16), 0), (np.zeros(0), 0)]
    full = [(i, [float(np.float32(x)) for x in v], y, "clash") for i, (v, y) in enumerate(rows)]
    one = full[0][1]
    n = len(full)
    return full + [(n, None, 0, ""), (n + 1, [*one[:15], float("nan")], 0, ""), (n + 2, [*one[:15], None], 0, ""), (n + 3, [*one[:15], float("inf")], 0, ""), (n + 4, one, 1, "")]


def brute(rows):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, float)
        return x / np.linalg.norm(x)

    units = [unit(r[1]) for r in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if rows[i][2] is None or rows[i][2] != rows[j][2] or a is None or b is None or len(a) != len(b):
                continue
            if a @ b >= 0.98:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {(r[0], links[i], rows[find(i)][0], find(i) == i) for i, r in enumerate(rows)}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block,axes", [(1024, 1), (7, 2)])
def test_links_equal_all_products(spark, monkeypatch, seed, block, axes):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    monkeypatch.setattr(near_vectors, "AXES", axes)
    rows = rows_of(seed)
    got = near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert {tuple(r) for r in got} == brute(rows)
    assert sum(r.n_links for r in got) > 20


def test_many_copies_and_no_rows(spark):
    rows = [(i, [1.0, 2.0, 2.0], 3, "") for i in range(500)] + [(900, [2.0, 4.0, 4.0], 3, "")]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(500, 0)}
    assert near_vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_suffix_bound_loses_no_pair():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 40))
    x[150:] = x[:150] + rng.normal(size=(150, 40)) * 0.2
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = near_vectors.linked_pairs(x, x, 0.97, True)
    want = np.argwhere(np.triu(x @ x.T >= 0.97, 1))
    assert {tuple(p) for p in want} == set(zip(i.tolist(), j.tolist(), strict=True))
