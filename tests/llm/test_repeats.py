from __future__ import annotations

import hashlib
import re

import numpy as np
from bindscope.llm import repeats, token_files
from bindscope.llm.queries import tokenizer_path


def brute(rows):
    first, words = {}, {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    for i in sorted(words):
        for a in range(len(words[i]) - 19):
            first.setdefault(tuple(words[i][a : a + 20]), (i, a))
    out = set()
    for i, w in words.items():
        gone = {a + j for a in range(len(w) - 19) if first[tuple(w[a : a + 20])] != (i, a) for j in range(20)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.add((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_matches_brute_force(spark, documents, prose, monkeypatch):
    assert {tuple(r) for r in repeats.dedup_substrings(documents).collect()} == brute(prose)
    monkeypatch.setattr(repeats, "FLUSH", 50)
    assert {tuple(r) for r in repeats.dedup_substrings(documents.repartition(3)).collect()} == brute(prose)


def test_small_vocabulary(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), " ".join("ab"[x] for x in rng.integers(0, 2, int(n)))) for i, n in enumerate(rng.integers(0, 400, 30))]
    rows += [(100, "a " * 100), (101, "a b " * 50), (102, "b a " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in repeats.dedup_substrings(df).collect()} == brute(rows)


def test_repeated_rows_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text, 1), (7, text, 1), (7, text, 1), (8, text, 1), (9, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((r.doc_id, r.n_removed) for r in repeats.dedup_substrings(df).collect()), key=str)
    assert got == [(7, 0), (7, 0), (8, 30), (9, 0), (None, 30)]
    assert repeats.dedup_substrings(df.limit(0)).count() == 0


def test_ids_with_several_texts_and_rows_without_id(spark):
    """A number per id and text, in the order of ids, then texts, gives what brute force gives."""
    rng = np.random.default_rng(8)
    part = [" ".join(f"p{k}w{i}" for i in range(30)) for k in range(4)]
    rows = [(int(rng.integers(0, 6)) if k % 4 else None, " ".join(part[int(i)] for i in rng.integers(0, 4, 2)) + f" x{k % 7}") for k in range(40)]
    rows += [(3, None), (3, None), (None, None), (None, ""), rows[5], rows[5]]
    kinds = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode(), r[1] is None))
    want = {kinds[i]: tuple(x) for i, *x in brute([(i, t) for i, (_, t) in enumerate(kinds)])}
    got = repeats.dedup_substrings(spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, id string").repartition(3)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == sorted(((r[0], *want[r]) for r in rows), key=str)


def test_blocks_round_trip():
    rng = np.random.default_rng(2)
    for ids in (np.array([7]), np.zeros(5, int), rng.integers(0, 2**32, 1024), np.concatenate([rng.integers(0, 50, 1000), [2**32 - 1, 49407]])):
        ids = ids.astype(np.uint32)
        assert (token_files.decode_block(b"xx" + token_files.encode_block(ids), 2) == ids).all()


def test_token_files(spark, prose, tmp_path):
    import zlib

    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [*prose, (5000, " Two  Spaces\n\tand <|endoftext|> 's o'clock  É é ́x 漢字 x ÜBER "), (-3, "word " * 3000)]
    df = spark.createDataFrame([(i, t, b"x") for i, t in [*rows, (None, "z")]], "doc_id long, text string, blocks binary")
    token_files.write_ids(df, str(tmp_path / "ids"), path)
    got = {r.doc_id: r for r in token_files.read_ids(spark, str(tmp_path / "ids")).collect()}
    at = 0
    for i, t in sorted(rows):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32, got[i].ids) == (at, len(ids) // 4, zlib.crc32(ids), ids)
        at += len(ids) // 4
    ids = np.array(tokenizer.encode("z", add_special_tokens=False).ids + [2], "<u4").tobytes()
    assert len(got) == len(rows) + 1 and (got[None].start, got[None].ids) == (at, ids)
    twice = spark.createDataFrame([(4, "b c"), (None, "x"), (4, "a"), (None, None), (3, "z"), (4, "a")], "doc_id long, text string").repartition(3)
    token_files.write_ids(twice, str(tmp_path / "twice"), path)
    back = sorted((r.start, r.doc_id, r.ids) for r in token_files.read_ids(spark, str(tmp_path / "twice")).collect())
    want = [(i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for i, t in [(3, "z"), (4, "a"), (4, "a"), (4, "b c"), (None, None), (None, "x")]]
    assert [r[1] for r in back] == [3, 4, 4, 4, None, None] and sorted(map(str, (r[1:] for r in back))) == sorted(map(str, want))
    assert [r[0] for r in back] == np.cumsum([0, *(len(r[2]) // 4 for r in back)])[:-1].tolist() and back[1][2:] != back[3][2:]
    token_files.write_ids(df.limit(0), str(tmp_path / "none"), path)
    assert token_files.read_ids(spark, str(tmp_path / "none")).count() == 0
