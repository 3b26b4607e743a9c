"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled texts: each holds the words that its class's
texts have significantly more often than the other's (a z-test over documents). A text's
windows of ``WINDOW`` words are compressed with either dictionary; a window that comes out
shorter with the toxic one holds more of toxic text. The differences of a text's windows are
summed up in a few figures, and a logistic function of them, fitted on other labelled texts
and weighted to the classes' true proportions, gives the score.

Labels are learnt from at most ``sample`` documents of each class (chosen by hash of the id
among rows that aren't held out): one half makes the dictionaries, the other calibrates.
Every other figure covers whole texts of all documents. Held out: crc32(doc_id as text)
mod 4 is 2.

Nulls and odd rows: a null, empty or wordless text scores as a text without evidence;
labels without id or class are ignored, of several for an id the larger counts; repeated
rows each return a row; a row without id keeps its null id; other columns are ignored. With
no label of one class, the score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindscope.llm.tokens import slices

WINDOW, LEVEL, MIN_Z = 16, 19, 4.5


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def telling_words(own: Counter, n_own: int, other: Counter, n_other: int) -> bytes:
    """Words that documents of one class have significantly more often."""
    out = []
    for w, c in own.items():
        p = (c + other[w] + 1) / (n_own + n_other + 2)
        if c / n_own - other[w] / n_other >= MIN_Z * (p * (1 - p) * (1 / n_own + 1 / n_other)) ** 0.5:
            out.append(w)
    return b" " + b" ".join(sorted(out)) + b" " * 8


@dataclass
class Model:
    """Dictionaries' contents and the calibration; a few kilobytes."""

    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def compressors(self) -> tuple:
        def one(content: bytes):
            options = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=256, dict_size=len(content), min_match=3, write_content_size=False,
                write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            )
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(dict_data=data, compression_params=options).compress

        return one(self.ordinary), one(self.toxic)

    def score(self, figures: np.ndarray) -> np.ndarray:
        x = np.c_[(figures - self.mean) / self.scale, np.ones(len(figures))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def figures(text: str | None, ordinary, toxic) -> list[float]:
    """Of the windows' differences: mean, largest, mean of the three largest, shares of at
    least 1, 3 and 5 bytes, and the logarithm of the number of at least 3."""
    words = tokens(text)
    if not words:
        return [0.0] * 7
    windows = [b" ".join(words[i : i + WINDOW]) for i in range(0, len(words), WINDOW)]
    d = np.sort([len(ordinary(w)) - len(toxic(w)) for w in windows])[::-1]
    return [d.mean(), d[0], d[:3].mean(), (d >= 1).mean(), (d >= 3).mean(), (d >= 5).mean(), np.log1p((d >= 3).sum())]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        slope = a.T @ (weight * (p - y)) + 0.05 * w
        bend = (a * (weight * p * (1 - p))[:, None]).T @ a + 0.05 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(toxic: list[str], ordinary: list[str], share: float) -> Model:
    halves = [(x[: (len(x) + 1) // 2], x[(len(x) + 1) // 2 :] or x) for x in (toxic, ordinary)]
    counts = [Counter(w for t in made for w in set(tokens(t))) for made, _ in halves]
    n = [max(1, len(made)) for made, _ in halves]
    model = Model(
        telling_words(counts[0], n[0], counts[1], n[1]), telling_words(counts[1], n[1], counts[0], n[0]), np.zeros(7), np.ones(7), np.zeros(8)
    )
    pair = model.compressors()
    x = np.array([figures(t, *pair) for _, rest in halves for t in rest])
    y = np.repeat([1.0, 0.0], [len(rest) for _, rest in halves])
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    weight = np.where(y == 1, share * len(y) / y.sum(), (1 - share) * len(y) / (len(y) - y.sum()))
    model.weights = logistic((x - model.mean) / model.scale, y, weight)
    return model


def held_out(doc: Column) -> Column:
    return F.coalesce(F.crc32(doc.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = 3000) -> Model | float:
    """A model, or the score of every text if a class has no labels."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = rows.filter(~held_out(F.col("doc_id")))
    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    order = F.xxhash64("doc_id", F.lit(20))
    picked = [rows.filter(F.col("toxic") == k).orderBy(order, "doc_id").limit(sample) for k in (1, 0)]
    # At most 2 * sample ids are broadcast, and as many texts reach the driver.
    ids = F.broadcast(picked[0].unionByName(picked[1]))
    found = docs.join(ids, "doc_id").select("doc_id", "text", "toxic").toArrow().to_pylist()
    found.sort(key=lambda r: (r["doc_id"] * 0x9E3779B97F4A7C15 % 2**64, r["text"] or ""))
    texts = [[r["text"] for r in found if r["toxic"] == k] for k in (1, 0)]
    if not texts[0] or not texts[1]:
        return share
    return fit(texts[0], texts[1], share)


def scorer(model: Model | float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = None if isinstance(model, float) else model.compressors()
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column(1).to_pylist()
                if pair is None:
                    score = np.full(len(texts), model)
                else:
                    score = model.score(np.array([figures(t, *pair) for t in texts]))
                yield pa.record_batch([part.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return rows


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 3000, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = learn(rows, labels, sample)
    scored = rows.mapInArrow(scorer(model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
