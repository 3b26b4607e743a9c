from __future__ import annotations

import math

import numpy as np
import pytest

from bindscope.llm import topk_search

SCHEMA = "vec_id long, embedding array<double>, score string, block int"


def brute(rows, k=5):
    x = {n: [math.floor(256 * v) for v in vector] for n, (_, vector) in enumerate(rows)}
    out = []
    for n, (query, _) in enumerate(rows):
        if query is None or query % 50:
            continue
        scores = [(-sum(a * b for a, b in zip(x[n], x[m])), i is None, i or 0, i) for m, (i, _) in enumerate(rows) if i != query]
        out += [(query, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda t: t[:3])[:k])]
    return sorted(out, key=str)


def vectors(kind, rng):
    x = rng.standard_normal((1500, 12))
    if kind == "unit":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "long tail":
        x *= rng.pareto(1.0, (1500, 1))
    if kind == "decay":
        x *= 0.5 ** np.arange(12)
    if kind == "ties":
        x = np.round(x)
        x[100:700] = x[0]
    if kind == "negative":
        x = -np.abs(x)
        x[::50] *= -1
    return x


@pytest.mark.parametrize("kind", ["unit", "long tail", "decay", "ties", "negative"])
def test_against_brute_force(spark, kind):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(kind, np.random.default_rng(2)))]
    got = topk_search.top_k(spark.createDataFrame([(i, v, "", 1) for i, v in rows], SCHEMA).repartition(4))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(120)] + [(None, [9.0] * 6), (None, [1.0] * 6), (-50, [0.0] * 6), (50, [3.0] * 6)]
    rows += [rows[100], rows[100], rows[3], rows[3]]
    bad = [(150, None), (200, []), (250, [1.0] * 5), (300, [None] + [9.0] * 5), (350, [math.nan] + [9.0] * 5), (400, [-math.inf] + [9.0] * 5)]
    got = topk_search.top_k(spark.createDataFrame([(i, v, "", 1) for i, v in rows + bad], SCHEMA).repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_few_rows(spark):
    assert topk_search.top_k(spark.createDataFrame([], SCHEMA)).collect() == []
    assert topk_search.top_k(spark.createDataFrame([(0, [1.0], "", 1)], SCHEMA)).collect() == []
    assert topk_search.top_k(spark.createDataFrame([(1, [1.0], "", 1), (2, [1.0], "", 1)], SCHEMA)).collect() == []
    two = topk_search.top_k(spark.createDataFrame([(0, [1.0], "", 1), (7, [-2.0], "", 1)], SCHEMA)).collect()
    assert [tuple(r) for r in two] == [(0, 1, 7, -2 * 256 * 256)]


def test_large_entries_are_exact_and_held(spark):
    rows = [(0, [2.0**30 + 1 / 256, 3.0]), (1, [2.0**14 + 1 / 256, 5.0]), (2, [2.0**14, 9.0]), (3, [1e300, 0.0]), (4, [-1e300, 0.0])]
    got = {r.vec_id: r.score for r in topk_search.top_k(spark.createDataFrame([(i, v, "", 1) for i, v in rows], SCHEMA)).collect()}
    x = {i: [math.floor(256 * v) for v in vector] for i, vector in rows}
    assert [got[i] for i in (1, 2)] == [sum(a * b for a, b in zip(x[0], x[i])) for i in (1, 2)]
    assert got[3] == 2**63 - 1 and got[4] == -(2**63)


def test_pruned_pairs_keep_every_winner():
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.standard_normal((3000, 8)) * rng.pareto(2.0, (3000, 1)))
    x = x[np.argsort(-topk_search.lengths(x))]
    turn = np.linalg.svd(x.T @ x)[0]
    queries, candidates = topk_search.Side(np.arange(40) + 10_000, x[::75], turn), topk_search.Side(np.arange(3000), x, turn)
    best = topk_search.Best(40, 5)
    topk_search.search(best, queries, candidates)
    exact = x[::75] @ x.T
    for q in range(40):
        order = np.lexsort((np.arange(3000), -exact[q]))[:5]
        assert best.ids[best.query == q].tolist() == order.tolist()
