"""Contour integration against a dense solver; whitening against numpy."""

import math

import numpy as np
import pytest

from tracelake.llm import feast, whitening

RNG = np.random.default_rng(4)
Q = np.linalg.qr(RNG.standard_normal((40, 40)))[0]
MATRICES = {
    "one": np.array([[3.0]]),
    "random": np.cov(RNG.standard_normal((300, 40)).T * RNG.uniform(0.1, 20, (40, 1))),
    "equal eigenvalues": Q @ np.diag([5.0] * 25 + [1.0] * 15) @ Q.T,
    "identity": np.eye(20),
    "few components": Q @ np.diag([100.0, 50.0] + [1e-3] * 10 + [0.0] * 28) @ Q.T,
    "falling fast": Q @ np.diag(10.0 ** -np.arange(40)) @ Q.T,
    "nothing": np.zeros((6, 6)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading_pairs(name):
    matrix = MATRICES[name]
    scale = np.abs(matrix).sum(axis=1).max()
    want = np.linalg.eigvalsh(matrix)[::-1]
    want = want[want > scale * len(matrix) * np.finfo(float).eps][:32]
    values, vectors = feast.leading(matrix, 32)
    assert len(values) == len(want) and np.allclose(values, want, rtol=1e-12, atol=1e-14 * scale)
    assert np.allclose(matrix @ vectors, vectors * values, atol=1e-13 * max(scale, 1))
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)


def test_inertia_counts():
    for shift in (-3.0, 0.0, 0.5, 4.0):
        a = RNG.standard_normal((25, 25))
        a = a + a.T
        assert feast.below(a, shift) == (np.linalg.eigvalsh(a) < shift).sum()
    assert feast.below(np.array([[0.0, 2.0], [2.0, 0.0]]), 0.0) == 1


SCHEMA = "vec_id long, embedding array<float>, n string, whitened int"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], SCHEMA)


def _whiten(table):
    model = whitening.fit(table)
    out = whitening.whiten(table, model)
    return model, whitening.digest(out, model, whitening.identity_error(out, model)).collect()


def test_rows_equal_numpy(spark):
    vectors = (RNG.standard_normal((400, 12)) * 3).astype(np.float32)
    rows = [(i if i % 50 else None, v.tolist()) for i, v in enumerate(vectors)] + [(7, vectors[7].tolist())]
    bad = [None, [], [1.0] * 5, [math.nan] + [0.0] * 11, [math.inf] + [0.0] * 11, [None] + [0.0] * 11, [1e30] + [0.0] * 11]
    model, got = _whiten(_table(spark, rows + [(900 + i, b) for i, b in enumerate(bad)]))
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    covariance = np.cov(x.T, bias=True)
    values = np.linalg.eigvalsh(covariance)[::-1]
    assert model.n == n and model.sums == total.tolist() and np.allclose(model.values, values, rtol=1e-12)
    assert len(got) == n * 12
    deviation = {}
    for (i, _), t in zip(rows, n * x - total, strict=True):
        deviation.setdefault(i, []).append(sum(int(e) ** 2 for e in t))
    assert all(r["deviation"] in deviation[r["vec_id"]] for r in got)
    assert all(abs(r["explained"] - values[r["component"] - 1] / values.sum()) < 1e-12 for r in got)
    one = sorted((r["component"], r["whitened"]) for r in got if r["vec_id"] == 3)
    want = (x[3] - total / n) @ model.vectors / np.sqrt(model.values)
    assert np.allclose([w for _, w in one], want, rtol=1e-9)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-10


def test_large_numbers_stay_exact():
    y = np.array([[1 << 40, 3], [-(1 << 40), 5]], np.int64)
    assert whitening.products(y)[0, 0] == 2 << 80
    assert [int(v) for v in whitening.squares(y)] == [(1 << 80) + 9, (1 << 80) + 25]


def test_nothing_to_whiten(spark):
    same = [(i, [1.0, 2.0]) for i in range(5)]
    for rows in ([], [(1, None)], [(1, [])], same):
        assert _whiten(_table(spark, rows))[1] == []
