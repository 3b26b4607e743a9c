from __future__ import annotations

import zlib

import corpus_pipeline
import numpy as np
from bindscope.llm import repeats
from bindscope.llm.queries import tokenizer_path


def test_pipeline_returns_sequences_that_give_back_the_texts(spark):
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids: dict[int, bytes] = {}
    for p in sorted(corpus_pipeline.run(spark, folder).collect(), key=lambda p: (p.doc_id, p.start)):
        assert len(p.ids) == 4 * p.length and zlib.crc32(p.ids) == p.ids_crc32
        ids[p.doc_id] = ids.get(p.doc_id, b"") + p.ids
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    assert {i: tokenizer.decode(np.frombuffer(raw, "<u4")[:-1].tolist(), skip_special_tokens=False) for i, raw in ids.items()} == texts


def test_kept_texts(spark):
    run = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(run)), (2, "é  before\n" + "  ".join(run) + "\tafter"), (3, None)]
    got = {r.doc_id: r.kept for r in repeats.kept_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: " ".join(run), 2: "é before after", 3: ""}
