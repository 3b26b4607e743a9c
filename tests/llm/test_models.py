from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from bindscope.llm import suffix_tree, toxicity
from bindscope.llm.tokens import Words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def base_scores(rows):
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    return {i: (held[i], len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens.items()}


@pytest.mark.parametrize("top", [0, 20, 1 << 18])
def test_base_score(documents, prose, top):
    got = suffix_tree.suffix_tree_scores(documents, top=max(top, 1)).collect()
    want = base_scores(prose)
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], abs=1e-6)
        assert r.score < 0


def direct(tree_levels, text):
    """Longest-suffix scoring by dictionaries."""
    out = 0.0
    words = text.lower().encode().split()
    stream, share = [], []
    for w in words:
        stream += [int(suffix_tree.SYMBOL[b]) for b in w] + [suffix_tree.SEPARATOR]
        share += [suffix_tree.SHARE[b] for b in w] + [0.0]
    stream, share = [0] * 5 + stream + [0], share + [0.0]
    for t in range(5, len(stream)):
        for order in range(5, -1, -1):
            key = sum(stream[t - 1 - k] << (6 * k) for k in range(order))
            if key in tree_levels[order]:
                out += math.log10(tree_levels[order][key][stream[t]]) + share[t - 5]
                break
    return out


def test_tree_scores_by_longest_suffix():
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "then", "other", "bother", "é", "no.", "42"]) for _ in range(60)) for _ in range(30)]
    stream = suffix_tree.Stream(Words(pa.array(texts), lower=True))
    codes = stream.codes(np.arange(len(stream.at)))
    levels = []
    for order in range(6):
        keys, counts = suffix_tree.summed(codes & ((1 << 6 * (order + 1)) - 1), np.ones(len(codes), np.int64))
        context = (keys >> np.uint64(6)).astype(np.int64)
        table = {}
        for c, k, n in zip(context.tolist(), (keys & np.uint64(63)).tolist(), counts.tolist()):
            table.setdefault(c, []).append((k, n))
        levels.append((np.array(list(table)), np.array([sum(n for _, n in v) for v in table.values()]),
                       [np.array(v, np.int64).tobytes() for v in table.values()]))
    tree = suffix_tree.grow(levels)
    assert np.allclose((10.0 ** tree.chance.reshape(-1, 64).astype(float)).sum(axis=1), 1, atol=1e-4)
    # The same retained contexts by plain dictionaries.
    smooth, kept = [], []
    for order, (keys, n, after) in enumerate(levels):
        smooth.append({})
        kept.append({})
        for key, total, raw in zip(keys.tolist(), n.tolist(), after):
            base = smooth[order - 1][key & ((1 << 6 * (order - 1)) - 1)] if order else [1 / 64] * 64
            pair = np.frombuffer(raw, np.int64).reshape(-1, 2).tolist()
            p = [len(pair) * b / (total + len(pair)) for b in base]
            for k, c in pair:
                p[k] += c / (total + len(pair))
            smooth[order][key] = p
            gain = total * sum(x * math.log(x / b) for x, b in zip(p, base))
            if order == 0 or gain > suffix_tree.PENALTY * len(pair) * math.log(max(total, 2)):
                kept[order][key] = p
    assert sum(len(k) for k in kept[2:]) > 5
    got = tree.score(Words(pa.array([*texts, "", "zzz other thenother"]), lower=True))
    for t, value in zip([*texts, "", "zzz other thenother"], got):
        assert value == pytest.approx(direct(kept, t), rel=1e-5)


def test_scores_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = suffix_tree.suffix_tree_scores(docs).filter("held_out").toPandas()
    assert held.score.sum() > held.base_score.sum() and (held.score <= 0).all()
    print(held.score.sum(), held.base_score.sum())


def test_scores_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a"), (1, None), (1, None), (3, "A a")], "doc_id long, text string")
    got = suffix_tree.suffix_tree_scores(df).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.held_out) for r in got), key=str) == [(1, 1, 1, True), (1, 1, 1, True), (3, 3, 3, False), (None, 2, 2, False)]
    assert {r.train_tokens for r in got} == {5}
    assert suffix_tree.suffix_tree_scores(df.limit(0)).count() == 0


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    out = toxicity.toxicity(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels).join(labels, "doc_id").filter("held_out").toPandas()
    hit = ((out.predicted == 1) & (out.toxic == 1)).sum()
    precision, recall = hit / max(1, (out.predicted == 1).sum()), hit / (out.toxic == 1).sum()
    print(precision, recall)
    assert precision > 0.8 and recall > 0.7


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a", 1.0), (1, None, 1.0), (1, None, 1.0), (2, "", 2.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 4 and all(r.score == 0 and r.predicted == 0 for r in got)
    both = spark.createDataFrame([(1, 1), (2, 0), (1, 1)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.toxicity(docs, both).collect())
    assert toxicity.toxicity(docs.limit(0), both).count() == 0
