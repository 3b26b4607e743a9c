from __future__ import annotations

import random
import zlib
from hashlib import sha256

from bindscope.llm import merkle
from bindscope.llm.queries import op12_merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, position long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def siblings(levels, at):
    found = []
    for level in levels[:-1]:
        found.append((at % 2, level[at ^ 1] if at ^ 1 < len(level) else None))
        at //= 2
    return found


def fold(node, way):
    for odd, other in way:
        node = h(other, node) if odd else h(node, other or "")
    return node


def brute(rows):
    leaves = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        one, two = (h(*map(field, (doc_id, source, lang, n, text))) for n in (n_chars, None if n_chars is None else n_chars + 1))
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        leaves.setdefault(lang, []).append((doc_id is not None, doc_id or 0, one, two if hit else one, doc_id))
    names = sorted(leaves, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: tree([x[2] for x in sorted(leaves[k], key=lambda x: x[:3])]) for k in names}
    top = tree([trees[k][-1][0] for k in names])
    out = []
    for place, k in enumerate(names):
        for at, (*_, leaf, changed, doc_id) in enumerate(sorted(leaves[k], key=lambda x: x[:3])):
            way = siblings(trees[k], at) + siblings(top, place)
            root = fold(changed, way)
            assert fold(leaf, way) == top[-1][0]
            out.append((doc_id, leaf, trees[k][-1][0], top[-1][0], h(*(x for _, x in way if x)), root, root == top[-1][0]))
    return sorted(out, key=str)


def report(spark, rows, folder, parts=3):
    spark.createDataFrame(rows, SCHEMA).repartition(parts).write.parquet(f"{folder}/documents.parquet")
    return sorted(map(tuple, op12_merkle_manifest(spark, str(folder)).collect()), key=str)


def test_trees_against_brute_force_with_odd_rows(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, f"text {i % 50} é" * rng.randint(0, 4), rng.choice(["de", "en", "fr", "", "ü", None]), "s" * (i % 3), i, "t", 1) for i in range(700)]
    rows += [(5, None, None, None, None, None, None)] * 2 + [(None, "a", "en", None, 2**63 - 1, "", 0), (None, None, "en", "x", 1, "", 0)]
    rows += [(9, "twice", "en", "s", 3, "", 0), (9, "other", "en", "s", 3, "", 0), (900, "alone", "zz", "s", None, "", 0), (14, "x" * 3_000_000, "long", "s", 2**63 - 1, "", 0)]
    got = report(spark, rows, tmp_path)
    assert got == brute(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_one_tree_one_leaf_and_empty(spark, tmp_path):
    for n, lang in ((0, "en"), (1, None), (33, "en")):
        rows = [(i, "t", lang, "s", i, "", 0) for i in range(n)]
        assert report(spark, rows, tmp_path / f"{n}{lang}", 1) == (brute(rows) if rows else [])


def test_runs_of_any_lengths_give_whole_proofs():
    rng = random.Random(1)
    for total in [1, 2, 3, 5, 8, 21, 64, 100, 129]:
        leaves = [h(str(i)).encode() for i in range(total)]
        levels = [[x.encode() for x in level] for level in tree([x.decode() for x in leaves])]
        cuts = sorted({0, total, *(rng.randrange(total) for _ in range(rng.randint(0, 9)))})
        own = {}
        for a, b in zip(cuts[:-1], cuts[1:]):
            for level, index, node in merkle.Run(a, total, leaves[a:b]).own():
                assert levels[level][index] == node and (level, index) not in own
                own[level, index] = node
        assert sum(min((i + 1) << n, total) - (i << n) for n, i in own) == total
        for a, b in zip(cuts[:-1], cuts[1:]):
            run = merkle.Run(a, total, leaves[a:b])
            lacks = list(run.lacking())
            assert len(lacks) <= 2 * run.height
            run.complete({(n, i): levels[n][i] for n, i in lacks})
            for at in range(a, b):
                assert run.proof(at) == [x.encode() for _, x in siblings([[y.decode() for y in level] for level in levels], at) if x]
                assert merkle.folded(leaves[at], at, total, iter(run.proof(at))) == levels[-1][0]
