from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest

from bindscope.llm import ngram_join

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def gram_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}


def brute(rows, n, t):
    sets = {i: gram_set(x, n) for i, x in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= t * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {(i, len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("n,t", [(3, 90), (5, 80), (2, 70)])
def test_matches_all_pairs(documents, prose, n, t):
    got = {tuple(r) for r in ngram_join.jaccard_components(documents, n, t).collect()}
    assert got == brute(prose, n, t)


def test_large_group_goes_through_pivots_and_strips(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(int(rng.integers(0, 5))):
            w[int(rng.integers(0, 120))] = f"z{rng.integers(0, 1000)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(ngram_join, "ROW_BLOCK", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in ngram_join.jaccard_components(df, 3, 90).collect()}
    assert got == brute(rows, 3, 90)


def test_unlike_rows_do_not_chain(spark, monkeypatch):
    """Overlapping texts agree in blocks with the next ones, but no two link: none is multiplied."""
    rng = np.random.default_rng(4)
    line = [f"w{x}" for x in rng.integers(0, 10**6, 4000)]
    rows = [(i, " ".join(line[40 * i : 40 * i + 200])) for i in range(45)]
    seen = []
    real = ngram_join.multiplied
    monkeypatch.setattr(ngram_join, "multiplied", lambda rows, *a: seen.append(rows.count()) or real(rows, *a))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in ngram_join.jaccard_components(df, 3, 90).collect()}
    assert got == brute(rows, 3, 90)
    assert sum(seen) == 0


def test_parities_keep_linked_pairs(spark):
    """Pairs of any sizes at the bound pass; unlike ones of equal size don't."""
    rng = np.random.default_rng(6)
    for size in (1, 3, 60, 64, 65, 130, 1000, 5000):
        grams = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        fewer, other = grams[: -(-90 * len(grams) // 100)], np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        pairs = [(1, 2, fewer), (1, 3, other)]
        batch = pa.record_batch(
            [pa.array([a for a, _, _ in pairs]), pa.array([b for _, b, _ in pairs]), pa.array([len(grams)] * 2), pa.array([len(x) for *_, x in pairs]),
             pa.array([ngram_join.parities(grams)] * 2), pa.array([ngram_join.parities(x) for *_, x in pairs])],
            names=["a", "b", "m", "n", "p", "q"],
        )
        kept = [b for r in ngram_join.may_link(90)([batch]) for b in r.column("b").to_pylist()]
        assert kept == [2] if size > 1 else 2 in kept


def test_empty_nulls_and_repeats(spark):
    schema = "doc_id long, text string, kind string, component_id string"
    assert ngram_join.jaccard_components(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d", "", ""), (2, "a b c d", "", ""), (2, "a b c d", "", ""), (1, "A b\tc d", "", ""), (5, None, "", "")]
    got = sorted(tuple(r) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, schema)).collect())
    assert got == [(1, 2, 1), (2, 2, 1), (2, 2, 1), (5, 0, 5)]


def test_keep_one(documents, prose):
    kept = {r.doc_id for r in ngram_join.keep_one(documents).collect()}
    assert kept == {c for _, _, c in brute(prose, 5, 80)}


def test_copies_are_cut_once(spark, monkeypatch):
    """Twelve copies of a text were 66 pairs in every bucket of blocks; now one row of a set is cut."""
    rng = np.random.default_rng(8)
    base = [[f"w{i}" for i in rng.integers(0, 10**6, 80)] for _ in range(20)]
    rows = [(100 * k + i, " ".join(w)) for i, w in enumerate(base) for k in range(12)]
    rows += [(5000 + i, " ".join(["new", *w[1:]])) for i, w in enumerate(base)]
    seen = []
    real = ngram_join.bounded
    monkeypatch.setattr(ngram_join, "bounded", lambda pairs, *a: seen.append(pairs.count()) or real(pairs, *a))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6, "doc_id")
    got = {tuple(r) for r in ngram_join.jaccard_components(df, 3, 90).collect()}
    assert got == brute(rows, 3, 90)
    assert seen == [20]


def test_first_rows(spark):
    """Copies are left out, rows without n-grams too; an id that repeats stays, as its sets may differ."""
    sizes = spark.createDataFrame([(1, 3), (4, 3), (5, 3), (5, 8), (9, 0)], "doc_id long, n_shingles long")
    same = spark.createDataFrame([(4, 1), (5, 1)], "a long, b long")
    assert sorted(r.doc_id for r in ngram_join.first_rows(sizes, same).collect()) == [1, 5]


def test_without_decides_most_rows_in_place(spark):
    rows = spark.range(3000).selectExpr("id * 7 AS k", "cast(id AS string) AS text")
    dropped = rows.filter("k % 6 <> 0").select("k")
    kept = ngram_join.without(rows, dropped, "k")
    assert sorted(r.k for r in kept.collect()) == [7 * i for i in range(3000) if 7 * i % 6 == 0]
