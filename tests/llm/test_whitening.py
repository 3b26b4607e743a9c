from __future__ import annotations

import math

import numpy as np
import pytest

from bindscope.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n long, key string"


def spectrum(kind, rng):
    if kind == "ties":
        basis = np.linalg.qr(rng.standard_normal((12, 12)))[0]
        return np.concatenate([basis, -basis] * 5)
    x = rng.standard_normal((300, {"wide": 16, "one": 1, "two": 2, "many": 90}.get(kind, 24)))
    if kind == "wide":
        return x * 10.0 ** -np.arange(16)
    if kind == "flat":
        x[:, 6:] = 3.0
    return x[:10] if kind == "few" else x


@pytest.mark.parametrize("kind", ["plain", "ties", "wide", "one", "two", "few", "flat", "many"])
def test_directions_and_values(kind):
    x = spectrum(kind, np.random.default_rng(4))
    x = x - x.mean(axis=0)
    r = np.zeros((x.shape[1], x.shape[1]))
    r[: min(x.shape)] = whitening.triangle(x)
    directions, values = whitening.solve(r, 8)
    want = np.linalg.svd(x, compute_uv=False)[: len(values)]
    own = int(np.count_nonzero(values))
    assert own == min(8, np.linalg.matrix_rank(x))
    assert np.allclose(np.sqrt(values[:own]), want[:own], rtol=1e-12)
    assert np.abs(directions[:own] @ directions[:own].T - np.eye(own)).max() < 1e-11
    assert np.abs(x.T @ (x @ directions[:own].T) - directions[:own].T * values[:own]).max() < 1e-11 * values[0]


def test_all_values_by_dqds():
    rng = np.random.default_rng(8)
    for n in (1, 2, 3, 40, 120):
        diagonal, upper = rng.standard_normal(n), rng.standard_normal(n - 1)
        upper[::5] = 0.0
        if n > 10:
            diagonal[7] = 0.0
        got = np.sqrt(whitening.squared_values(diagonal, upper))
        want = np.linalg.svd(np.diag(diagonal) + np.diag(upper, 1), compute_uv=False)
        assert np.abs(got - want).max() < 1e-13 * want[0]


def test_whiten_against_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = [(i * 3, [float(np.float32(v)) for v in rng.standard_normal(10) * 0.2]) for i in range(400)]
    good += [good[0], good[0], (None, good[5][1])]
    bad = [(-1, None), (-2, []), (-3, [0.5] * 9), (-4, [0.1] * 9 + [None]), (-5, [float("nan")] + [0.0] * 9), (-6, [math.inf] + [0.0] * 9)]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in good + bad], SCHEMA).repartition(5)
    rows = whitening.whiten(df).collect()
    assert len(rows) == 8 * len(good)
    x = np.floor(1024 * np.array([v for _, v in good])).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    values, vectors = np.linalg.eigh((x - sums / n).T @ (x - sums / n) / n)
    order = np.argsort(-values)[:8]
    want = (x - sums / n) @ vectors[:, order] / np.sqrt(values[order])
    by_id = {}
    for i, (key, _) in enumerate(good):
        by_id.setdefault(key, i)
    got = np.array([[r.whitened * math.copysign(1, r.whitened * want[by_id[r.vec_id], r.component - 1])] for r in rows])
    assert np.abs(got[:, 0] - [want[by_id[r.vec_id], r.component - 1] for r in rows]).max() < 1e-9
    signs = {}
    for r in rows:  # a component has one sign for all rows
        expected = want[by_id[r.vec_id], r.component - 1]
        if abs(expected) > 1e-6:
            signs.setdefault(r.component, set()).add(r.whitened * expected > 0)
    assert all(len(s) == 1 for s in signs.values())
    assert all(r.n == n and r.deviation == int(((n * x[by_id[r.vec_id]] - sums) ** 2).sum()) for r in rows)
    assert all(abs(r.explained - values[order][r.component - 1] / values.sum()) < 1e-12 for r in rows)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9


def test_whiten_without_extent(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    same = whitening.whiten(spark.createDataFrame([(i, [0.5, 0.25], 1, "") for i in range(3)], SCHEMA)).collect()
    assert len(same) == 6 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in same)
    line = whitening.whiten(spark.createDataFrame([(i, [i / 4, 0.25], 1, "") for i in range(3)], SCHEMA)).collect()
    assert {(r.component, r.explained, r.whitened is None) for r in line} == {(1, 1.0, False), (2, 0.0, True)}


def test_huge_entries(spark):
    rows = whitening.whiten(spark.createDataFrame([(1, [3e38, 0.0], 1, ""), (2, [-3e38, 0.5], 1, ""), (3, [0.0, 0.0], 1, "")], SCHEMA)).collect()
    assert len(rows) == 6 and any(r.deviation is None for r in rows)
