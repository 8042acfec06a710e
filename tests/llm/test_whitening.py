"""Whitening against a direct eigendecomposition, and its defined cases."""

import math

import numpy as np
import pytest

from loamflow.llm import whitening as W


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(rows)],
                                 "vec_id long, embedding array<float>, dims string, component int")


def plain(rows, k):
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for v in rows], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    value, vector = np.linalg.eigh(y.T @ y / n)
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    return n, [sum(int(c) ** 2 for c in n * r - s) for r in x], y @ vector / np.sqrt(value), value / np.trace(y.T @ y / n)


def whitened(out, k):
    out = sorted(out, key=lambda r: (r.vec_id, r.component))
    return np.array([r.whitened for r in out]).reshape(-1, k)


@pytest.mark.parametrize("dims,count", [(12, 200), (40, 400), (100, 300)])
def test_equals_a_direct_decomposition(spark, dims, count):
    rng = np.random.default_rng(dims)
    rows = (rng.standard_normal((count, dims)) @ np.diag(1 / np.arange(1, dims + 1) ** 0.5)).astype(np.float32).tolist()
    k = 8
    out = W.whiten(frame(spark, rows)).collect()
    n, deviation, want, explained = plain(rows, k)
    have = whitened(out, k)
    assert np.allclose(have * np.sign((have * want).sum(axis=0)), want, atol=1e-6)
    for r in out:
        assert r.n == n and int(r.deviation) == deviation[r.vec_id]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9


def test_rows_that_are_dropped(spark):
    good = [[1.0, 2.0], [0.5, -1.0], [3.0, 0.0], [1.0, 2.0]]
    bad = [None, [], [1.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0]]
    out = W.whiten(frame(spark, good + bad)).collect()
    assert {r.vec_id for r in out} == {0, 1, 2, 3} and {r.component for r in out} == {1, 2}
    assert {r.n for r in out} == {4}


def test_no_variance_and_empty(spark):
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [[1.0, 2.0]] * 5)).count() == 0
    assert W.whiten(frame(spark, [None, []])).count() == 0
    line = W.whiten(frame(spark, [[1.0, 2.0, 0.0], [2.0, 4.0, 0.0], [4.0, 8.0, 0.0]])).collect()
    assert {r.component for r in line} == {1} and line[0].identity_error < 1e-9


def test_equal_eigenvalues(spark):
    rows = np.vstack([np.eye(20), -np.eye(20)]).tolist()
    out = W.whiten(frame(spark, rows)).collect()
    y = whitened(out, 8)
    assert np.allclose(y.T @ y / 40, np.eye(8), atol=1e-9)


def test_large_deviations_stay_exact():
    x = np.array([[10 ** 9, 0], [5, 7]])
    assert [int(v.as_py()) for v in W._deviations(x, 10 ** 4, np.array([1, 2]))] == [
        (10 ** 13 - 1) ** 2 + 4, 49999 ** 2 + 69998 ** 2]


def test_restarts_in_a_large_space():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    a = (q * np.linspace(1, 2, 300) ** 3) @ q.T
    value, vector = W.jacobi_davidson(lambda u: a @ u, 300, 6)
    assert np.allclose(value, np.linalg.eigvalsh(a)[::-1][:6], rtol=1e-12)
    assert np.linalg.norm(a @ vector - vector * value, axis=0).max() < 1e-12
