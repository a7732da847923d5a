"""Jacobi-Davidson against dense eigensolvers, and whitened vectors against numpy."""

from __future__ import annotations

import numpy as np
import pytest

from stagehouse.llm.whitening import block_minres, jacobi_davidson, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def dense(matrix):
    def product(u):
        product.calls += 1
        return matrix @ u

    product.calls = 0
    return product


@pytest.mark.parametrize("d,k", [(1, 4), (7, 3), (64, 32), (200, 32), (400, 5)])
def test_pairs_reach_double_precision(d, k):
    r = np.random.default_rng(d)
    q = np.linalg.qr(r.standard_normal((d, d)))[0]
    values = np.sort(r.random(d) ** 4)[::-1]
    matrix = (q * values) @ q.T
    product = dense(matrix)
    found, vectors, residuals = jacobi_davidson(product, d, k)
    assert np.allclose(found, values[: min(k, d)], atol=1e-13, rtol=0)
    exact = np.linalg.norm(matrix @ vectors - vectors * found, axis=0)
    assert max(exact.max(), residuals.max()) < 1e-13
    assert np.abs(vectors.T @ vectors - np.eye(min(k, d))).max() < 1e-13
    assert product.calls < 120


def test_multiple_and_zero_eigenvalues():
    r = np.random.default_rng(3)
    q = np.linalg.qr(r.standard_normal((90, 90)))[0]
    values = np.array([5.0] * 6 + [2.0] * 10 + [0.0] * 74)
    found, vectors, _ = jacobi_davidson(dense((q * values) @ q.T), 90, 20)
    assert np.allclose(found, values[:20], atol=1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(20)).max() < 1e-13


def test_minres_solves_indefinite_systems():
    r = np.random.default_rng(4)
    matrix = r.standard_normal((30, 30))
    matrix += matrix.T
    right = np.hstack([r.standard_normal((30, 4)), np.zeros((30, 1))])
    x = block_minres(lambda z: matrix @ z, right, 60, 1e-11)
    assert np.abs(matrix @ x - right).max() < 1e-8 and not x[:, 4].any()


def made(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return whiten(df, **how).collect()


def check(vectors: dict, rows, k: int):
    """``rows`` against the definition, with numpy and exact integers."""
    ids = sorted(vectors)
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in vectors[i]] for i in ids])
    n, d = x.shape
    sums = x.sum(axis=0)
    exact = x - sums / n
    covariance = exact.T @ exact / n
    values, q = np.linalg.eigh(covariance)
    values, q = values[::-1][:k], q[:, ::-1][:, :k]
    expected = exact @ q / np.sqrt(values)
    got = np.zeros((n, k))
    for r in rows:
        at = ids.index(r.vec_id)
        got[at, r.component - 1] = r.whitened
        assert r.n == n
        far = sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[at], sums))
        assert r.deviation == far and r.deviation_digits == str(far)
        assert abs(r.explained - values[r.component - 1] / np.trace(covariance)) < 1e-10
        assert r.identity_error < 1e-9
    assert len(rows) == n * k
    got *= np.sign(np.sum(got * expected, axis=0))
    assert np.abs(got - expected).max() < 1e-6


@pytest.mark.parametrize("d,k", [(6, 32), (40, 8)])
def test_against_numpy(spark, d, k):
    r = np.random.default_rng(d)
    base = r.standard_normal((300, d)) * np.linspace(3, 0.5, d) + r.standard_normal(d)
    vectors = {i * 7 - 50: [float(v) for v in row] for i, row in enumerate(base)}
    rows = [(i, v, 0) for i, v in vectors.items()]
    bad = [[float("nan")] * d, [float("inf")] + [0.0] * (d - 1), [None] + [1.0] * (d - 1), None]
    bad += [[1.0] * (d + 1), [], [1e30] * d]
    rows += [(10_000 + i, v, None) for i, v in enumerate(bad)]
    check({i: v for i, v in vectors.items()}, made(spark, rows, components=k), min(k, d))


def test_equal_rows_few_rows_and_empty_table(spark):
    assert made(spark, []) == []
    assert made(spark, [(1, None, 0)]) == []
    assert made(spark, [(1, [1.0, 2.0], 0)] * 5) == []
    few = made(spark, [(1, [0.0, 0.0, 5.0], 0), (2, [1.0, 0.0, 5.0], 0), (None, [3.0, 0.0, 5.0], 0)])
    assert {r.component for r in few} == {1} and len(few) == 3
    assert {r.vec_id for r in few} == {1, 2, None}


def test_exact_beyond_64_bits(spark):
    rows = [(i, [float(1 << 45) * (i % 3), float(i)], 0) for i in range(9)]
    found = made(spark, rows)
    x = [[int(64 * v) + 1_000_000 for v in row[1]] for row in rows]
    sums = [sum(c) for c in zip(*x)]
    for r in found:
        far = sum((9 * v - s) ** 2 for v, s in zip(x[r.vec_id], sums))
        assert r.deviation_digits == str(far)
        assert r.deviation == (far if far < 1 << 63 else None)


def test_clashing_column_names(spark):
    df = spark.createDataFrame(
        [(i, [float(i), float(i * i % 7)], "a", 1.5) for i in range(20)],
        "vec_id long, embedding array<double>, n string, component double",
    )
    assert len(whiten(df.withColumnsRenamed({"n": "id", "component": "x"})).collect()) == 40
    assert len(whiten(df).collect()) == 40
