from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from bindscope.llm import ngram_join, quality


@pytest.fixture(scope="module")
def batch():
    """8 MB of text in 160 rows."""
    rng = np.random.default_rng(4)
    texts = [" ".join(map(str, rng.integers(0, 10**9, 5000))) for _ in range(160)]
    rows = len(texts)
    return pa.record_batch(
        [pa.array(range(rows)), pa.array(texts), pa.array(["en"] * rows), pa.array([1] * rows), pa.array([3] * rows)],
        names=["doc_id", "text", "lang", "task", "side"],
    )


@pytest.mark.parametrize("step,columns", [
    (ngram_join.scan(5, 80, 12), ["doc_id", "text"]), (ngram_join.weigh(5, 12), ["doc_id", "text"]),
    (ngram_join.product(5, 80), ["task", "side", "doc_id", "text"]), (quality.totals, ["text", "lang"]),
])
def test_a_batch_is_not_hashed_at_once(batch, step, columns):
    """Workers hold arrays of a piece of a batch, however large the batch is: 64-bit arrays of 8 MB took 92 to 280 MB."""
    tracemalloc.start()
    try:
        for _ in step(iter([batch.select(columns)])):
            pass
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert peak < 80, peak
