"""Whitening against exact fractions and numpy, clustered eigenvalues, odd rows."""

from fractions import Fraction
from math import floor, inf, nan

import numpy as np
import pytest

from tickerloom.llm.eigen_refine import product, refined_eigenvectors
from tickerloom.llm.whitening import by_component, whiten

SCHEMA = "vec_id long, embedding array<float>, n string, vector string, whitened int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "n", "v", 1) for i, v in enumerate(vectors)], SCHEMA)


def test_against_exact_covariance(spark):
    draw = np.random.default_rng(3)
    raw = (draw.normal(size=(300, 6)) @ draw.normal(size=(6, 6))).astype(np.float32)
    vectors = [list(map(float, v)) for v in raw]
    rows = by_component(whiten(frame(spark, vectors + [vectors[0]] * 150))).collect()
    x = [[floor(64 * c) + 1000000 for c in v] for v in vectors + [vectors[0]] * 150]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    centred = [[Fraction(n * c - s, n) for c, s in zip(v, sums)] for v in x]
    cov = np.array([[float(sum(v[i] * v[j] for v in centred) / n) for j in range(6)] for i in range(6)])
    values, basis = np.linalg.eigh(cov)
    assert len(rows) == 6 * n
    for row in rows:
        e, vector = values[-row.component], basis[:, -row.component]
        got = float(np.array([float(c) for c in centred[row.vec_id]]) @ vector) / np.sqrt(e)
        assert abs(abs(row.whitened) - abs(got)) < 1e-9
        assert row.deviation == sum((n * c - s) ** 2 for c, s in zip(x[row.vec_id], sums))
        assert row.n == n and row.identity_error < 1e-9
        assert row.explained == pytest.approx(e / np.trace(cov), rel=1e-10)


def test_odd_rows_are_dropped_or_defined(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [3.0, 5.0]]
    bad = [None, [], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 2.0, 3.0]]
    rows = whiten(frame(spark, good + bad)).collect()
    assert sorted(r.vec_id for r in rows) == [0, 1, 2]
    assert all(len(r.whitened) == 2 and r.n == 3 and r.identity_error < 1e-9 for r in rows)
    assert whiten(frame(spark, good).limit(0)).count() == 0
    assert whiten(frame(spark, bad[:5])).count() == 0
    same = by_component(whiten(frame(spark, [[1.0, 2.0]] * 5))).collect()
    assert {(r.whitened, r.explained, r.identity_error, r.deviation) for r in same} == {(0.0, 0.0, 0.0, 0)}
    line = by_component(whiten(frame(spark, [[k, k] for k in (1.0, 2.0, 4.0)]))).where("component = 2").collect()
    assert {(r.whitened, r.explained) for r in line} == {(0.0, 0.0)}


def test_large_entries_stay_exact_or_raise(spark):
    rows = whiten(frame(spark, [[2.0**20], [-(2.0**20)], [2.0**20]])).collect()
    x = [2**26 + 1000000, -(2**26) + 1000000, 2**26 + 1000000]
    assert {r.vec_id: r.deviation for r in rows} == {i: (3 * c - sum(x)) ** 2 for i, c in enumerate(x)}
    with pytest.raises(Exception, match="OverflowError"):
        whiten(frame(spark, [[2.0**60], [1.0]])).collect()


@pytest.mark.parametrize(
    "values",
    [
        [3.0] * 5 + [1.0] * 7,
        [5 + 1e-9 * k for k in range(6)] + [2 + 1e-12 * k for k in range(6)],
        [10.0**-k for k in range(12)],
        [4.0, 3.0, 1.0] + [0.0] * 9,
    ],
)
def test_close_eigenvalues(values):
    draw = np.random.default_rng(5)
    q = np.linalg.qr(draw.normal(size=(12, 12)))[0].astype(np.longdouble)
    for _ in range(2):
        q = q + product(q, (np.eye(12) - product(q.T, q)) / 2)
    a = product(q * np.array(values, dtype=np.longdouble), q.T)
    a = ((a + a.T) / 2).astype(float)
    got, x = refined_eigenvectors(a)
    exact = a.astype(np.longdouble)
    assert np.abs(product(x.T, x) - np.eye(12)).max() < 1e-17
    assert np.abs(product(exact, x) - x * got).max() < 1e-17
    assert np.abs(np.sort(values)[::-1] - got.astype(float)).max() < 1e-15
