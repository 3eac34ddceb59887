"""Whitening against numpy's eigenvectors and exact integers."""

import random

import numpy as np
import pytest

from tidemark.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x map<string,int>, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, {"a": 1}, "z") for i, v in rows], SCHEMA).repartition(4)


def rows_of(n=300, d=12, seed=0):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, d)) * np.linspace(2, 0.3, d) @ np.linalg.qr(rng.standard_normal((d, d)))[0] + 3
    rows = [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(v)]
    bad = [(900, None), (901, [None] * d), (902, [float("nan")] + [0.0] * (d - 1)), (903, [float("inf")] * d)]
    return rows + [rows[3], rows[3], (None, rows[5][1]), (5, rows[6][1])] + bad


def usable(rows):
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    d = max((len(v) for _, v in fine), default=0)
    x = np.array([np.floor(64 * np.float64(np.array(v + [0.0] * (d - len(v))))).astype(int) + 1_000_000 for _, v in fine])
    return [i for i, _ in fine], x


@pytest.mark.parametrize("components", [5, 32])
def test_equals_numpy(spark, components):
    rows = rows_of()
    ids, x = usable(rows)
    n, k = len(x), min(components, x.shape[1])
    c = x - x.mean(0)
    v = c.T @ c / n
    values = np.linalg.eigvalsh(v)[::-1]
    vectors = np.linalg.eigh(v)[1][:, ::-1].T
    got = W.whiten(frame(spark, rows), components).collect()
    assert len(got) == n * k
    by = {}
    for r in got:
        assert r.n == n and 1 <= r.component <= k and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-12
        by.setdefault((r.vec_id, r.component), []).append((r.deviation, r.whitened))
    sums = [int(s) for s in x.sum(0)]
    sign = {}
    want = {}
    for at, i in enumerate(ids):
        deviation = sum((n * int(a) - s) ** 2 for a, s in zip(x[at], sums))
        for k_ in range(k):
            want.setdefault((i, k_ + 1), []).append((deviation, c[at] @ vectors[k_] / values[k_] ** 0.5))
    assert set(by) == set(want)
    for key, found in want.items():
        for (d1, w1), (d2, w2) in zip(sorted(by[key]), sorted(found)):
            assert d1 == d2
            if abs(w2) > 1e-3 and len(found) == 1:
                sign.setdefault(key[1], w1 * w2 > 0)
                assert abs(w1 - (w2 if sign[key[1]] else -w2)) < 1e-8


def test_short_vectors_equal_vectors_and_empty_tables(spark):
    rows = [(i, [random.Random(i).random() for _ in range(1 + i % 4)]) for i in range(50)] + [(99, [])]
    ids, x = usable(rows)
    got = W.whiten(frame(spark, rows)).collect()
    assert len(got) == len(ids) * 4
    assert {r.vec_id for r in got} == set(ids)
    assert W.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(9)])).count() == 0
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [(1, None), (2, [])])).count() == 0


def spectrum(values, seed=0):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))[0]
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(9, 1, 30),
        [5.0] * 4 + [3.0] * 7 + [1.0] * 9,
        [4.0, 2.0, 1.0] + [0.0] * 15,
        np.r_[1 + 1e-9 * np.arange(8), np.linspace(0.1, 0.5, 12)],
        10.0 ** -np.linspace(0, 9, 20),
        [7.0],
    ],
)
def test_slices_find_the_leading_spectrum(values):
    v = spectrum(np.array(values))
    v = (v + v.T) / 2
    e, w = W.leading(v, 10)
    want = np.linalg.eigvalsh(v)[::-1][:10]
    want = want[want > 1e-12 * want[0]]
    assert len(e) == len(want)
    assert np.abs(e - want).max() <= 1e-13 * want[0]
    assert np.abs(w @ w.T - np.eye(len(e))).max() < 1e-9
    assert np.abs(w @ v - e[:, None] * w).max() <= 1e-13 * want[0]


def test_pivots_count_negative_eigenvalues():
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 17):
        a = rng.standard_normal((d, d))
        a = a + a.T
        np.fill_diagonal(a, 0)  # needs pivots of two
        assert W.negatives(a) == (np.linalg.eigvalsh(a) < 0).sum()
    assert W.negatives(np.zeros((4, 4))) == 0


def test_products_are_exact_beyond_doubles():
    c = np.array([[2**40, -3], [2**41 + 1, 5]])
    want = [[(2**40) ** 2 + (2**41 + 1) ** 2, -3 * 2**40 + 5 * (2**41 + 1)], [-3 * 2**40 + 5 * (2**41 + 1), 34]]
    assert W.products(c).tolist() == want
