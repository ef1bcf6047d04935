from __future__ import annotations

import numpy as np
import pytest

from larkspur.llm import embed_dedup as E


def brute(vectors, weights, cosine=0.95):
    linked = vectors @ vectors.T >= cosine
    np.fill_diagonal(linked, False)
    parent = list(range(len(vectors)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(*np.nonzero(linked), strict=True):
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    return linked @ weights, [find(x) for x in range(len(vectors))]


def joined(edges, n):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("seed", range(12))
def test_dual_traversal_is_exact(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    dims, n = int(rng.choice([3, 8, 64])), int(rng.choice([1, 60, 500]))
    monkeypatch.setattr(E, "DENSE", int(rng.choice([1, 64, 1 << 18])))
    monkeypatch.setattr(E, "OPEN", int(rng.choice([1, 256])))
    middle = rng.normal(size=(max(1, n // int(rng.choice([2, 20]))), dims))
    v = middle[rng.integers(0, len(middle), n)] + rng.normal(size=(n, dims)) * rng.choice([0.05, 0.3])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    weights = rng.integers(1, 4, n)
    degree, roots = brute(v, weights)
    half = n // 2
    left, right = (E.Block(v[s], weights[s], E.build_paths(v[s])) for s in (slice(0, half), slice(half, n)))
    tasks = [(E.DualJoin(left, None, 0.95), 0, 0), (E.DualJoin(right, None, 0.95), half, half), (E.DualJoin(left, right, 0.95), 0, half)]
    got, edges = np.zeros(n, dtype=np.int64), []
    for task, a, b in tasks:
        if not len(task.a.vectors) or not len(task.b.vectors):
            continue
        task.run()
        got[a : a + len(task.degree_a)] += task.degree_a
        if not task.same:
            got[b : b + len(task.degree_b)] += task.degree_b
        edges += [(x + a, y + b) for p, q in task.edges for x, y in zip(p.tolist(), q.tolist(), strict=True)]
    assert (got == degree).all() and joined(edges, n) == roots


def test_table(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    v = (base[rng.integers(0, 40, 300)] + 0.1 * rng.normal(size=(300, 16))).astype(np.float32)
    v[100:160] = v[7]
    rows = [(int(k), [float(x) for x in row], k % 3) for k, row in enumerate(v)]
    found = {r.id: (r.n_links, r.component) for r in E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int")).collect()}
    unit = v.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    degree, roots = brute(unit, np.ones(300, dtype=int))
    assert found == {k: (int(degree[k]), roots[k]) for k in range(300)}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []),
        (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.01]), (1, [1.0, 0.0]), (10, [-1.0, 0.0]),
    ]
    found = sorted((r.id or 0, r.n_links, r.component) for r in E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    alone = [(k, 0, k) for k in (3, 4, 5, 6, 7, 8, 9, 10)]
    assert found == sorted([(0, 3, 1), (1, 3, 1), (1, 3, 1), (2, 3, 1), *alone])


def test_empty(spark):
    assert E.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert E.near_duplicates(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 1
