"""Whitening against an eigendecomposition of the centred covariance and exact integers."""
import math

import numpy as np
import pytest

from boxwise.llm import whitening as w

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, n int, whitened string"


@pytest.fixture(scope="module")
def frame(spark):
    from boxwise.session import ship_package
    ship_package(spark)

    def make(vectors, ids=None):
        ids = range(len(vectors)) if ids is None else ids
        return spark.createDataFrame([(i, v, 1, "x", 2, "y") for i, v in zip(ids, vectors)], SCHEMA).repartition(4)
    return make


def expected(vectors):
    """(distinct x, S, V) in Python's integers and one float step."""
    x = {tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors}
    n, s = len(x), [sum(c) for c in zip(*x)]
    y = np.array([[(n * a - b) / n for a, b in zip(v, s)] for v in x])
    return x, s, y.T @ y / n


def check(rows, vectors, ids, components=16):
    x, s, v = expected(vectors)
    n = len(x)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-9 * e[0]).sum()))
    assert len(rows) == len(vectors) * k
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    signs = {}
    for i, vec in zip(ids, vectors):
        xs = [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vec]
        gap = [n * a - b for a, b in zip(xs, s)]
        for c in range(1, k + 1):
            want = sum(g / n * u for g, u in zip(gap, q[:, c - 1])) / math.sqrt(e[c - 1])
            for r in by[i][c]:
                assert r.n == n and r.deviation == sum(g * g for g in gap)
                assert abs(r.explained / (e[c - 1] / np.trace(v)) - 1) < 1e-9
                assert r.identity_error < 1e-9
            if abs(want) > 1e-3:
                signs.setdefault(c, by[i][c][0].whitened * want > 0)
            if c in signs:
                assert abs(by[i][c][0].whitened - (want if signs[c] else -want)) < 1e-6 * (1 + abs(want))


def test_equals_an_eigendecomposition(frame):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(0, 0.3, (300, 24)) * np.linspace(2, 0.2, 24)).astype("f4").tolist()
    vectors += vectors[:50] + [vectors[7]] * 40              # copies count once in the fit
    ids = list(range(len(vectors)))
    check(w.whiten(frame(vectors, ids)).collect(), vectors, ids)


def test_few_dimensions_and_low_rank(frame):
    rng = np.random.default_rng(2)
    two = rng.integers(-5, 6, (60, 2)).astype(float)
    vectors = [[a, b, a + b, 0.0, 1.0] for a, b in two.tolist()]     # rank two
    check(w.whiten(frame(vectors)).collect(), vectors, range(60))


def test_rows_left_out(frame, spark):
    rng = np.random.default_rng(3)
    good = rng.normal(0, 1, (30, 4)).astype("f4").tolist()
    bad = [None, [1.0, None, 2.0, 3.0], [1.0, math.nan, 0.0, 0.0], [math.inf, 0.0, 0.0, 0.0], [0.0, 3e38, 0.0, 0.0], [1.0, 2.0], []]
    rows = w.whiten(frame(good + bad, [None, *range(1, 37)])).collect()
    assert {r.vec_id for r in rows} == {None, *range(1, 30)} and len(rows) == 30 * 4
    check(rows, good, [None, *range(1, 30)])
    assert w.whiten(frame(good).limit(0)).count() == 0
    assert w.whiten(frame([good[0]] * 5)).count() == 0       # no variance, no component
    assert w.whiten(frame(bad)).count() == 0
    assert w.whiten(frame([[0.5, 0.25], [0.5, 0.25], [1.5, -0.25]], [1, 1, 2])).count() == 3


def test_large_entries_stay_exact(frame):
    vectors = [[2.0 ** 40, 0.0], [2.0 ** 41, 1.0], [0.0, 2.0]]
    x, s, _ = expected(vectors)
    rows = w.whiten(frame(vectors)).collect()
    for r in rows:
        xs = [math.floor(64 * c) + 1_000_000 for c in vectors[r.vec_id]]
        exact = sum((3 * a - b) ** 2 for a, b in zip(xs, s))
        assert r.deviation == (exact if exact < 2 ** 63 else None)


@pytest.mark.parametrize("d,rank", [(1, 1), (2, 2), (7, 3), (64, 64), (33, 20)])
def test_factor_and_rotations(d, rank):
    rng = np.random.default_rng(d)
    b = rng.normal(0, 1, (d, rank)) * np.geomspace(1, 1e-3, rank)
    a = b @ b.T
    g = w.pivoted_cholesky(a)
    assert g.shape[1] == rank and np.allclose(g @ g.T, a, atol=1e-12 * np.abs(a).max())
    e, q = w.one_sided_jacobi(g)
    assert np.allclose(q.T @ q, np.eye(rank), atol=1e-10)
    want = np.linalg.svd(b, compute_uv=False) ** 2
    assert np.allclose(e, want, rtol=1e-8)
    assert np.allclose(a @ q, q * e, atol=1e-10 * e[0])
