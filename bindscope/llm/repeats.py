"""Substring dedup by de Bruijn compaction.

Runs of 20 words are the edges of a de Bruijn graph (its nodes are runs of 19). Consecutive
edges of a text that share their minimizer (the leftmost least hash of the 8-word grams inside)
form a compacted path of up to 13 edges, so a text of n words gives about n / 7 paths, not n
edges. Equal edges have equal minimizers, so paths meet by minimizer:

1. Paths with equal words (minimizer and content hash, 128 bits) are one path; every
   occurrence but the first repeats in full.
2. A minimizer with several distinct paths is a branch: only there an edge can recur in part of
   another path. Its first occurrences are cut into their edges, read again at their source
   coordinates, and these meet by edge hash (128 bits).

An occurrence is a source coordinate (document, word). Tasks settle their own repeats before the
exchange, so a hot path sends one row per task. Nothing is capped.

Nulls and odd rows: a null, empty or short text repeats nothing. Rows of equal id and text are
one document, which returns a row for each; rows of one id with different texts are documents
in the order of their texts; rows without id come after all others, in the order of their
texts. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindscope.llm import shared
from bindscope.llm.tokens import MIX_A, U, Spans, Words, mix, packed, ranges, slices, window_starts
from bindscope.operators.ranking import add_rank
from bindscope.session import scratch

EDGE, GRAM = 20, 8
FLUSH = 1 << 20
REPEAT, PATH = 0, 1
BLOBS = "bucket int, kind int, keys binary, docs binary, starts binary, sizes binary"
FOUND = "kind int, doc_id long, start long, n long, source_doc long, source_start long"
Entries = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # keys (n, 2), docs, starts, sizes


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least of values[i : i + width], for each i that has so many."""
    n = len(values) - width + 1
    place = np.arange(len(values))
    best, span = values, 1

    def join(a, pa_, b, pb):
        right = b < a
        return np.where(right, b, a), np.where(right, pb, pa_)

    while span * 2 <= width:
        best, place = join(best[:-span], place[:-span], best[span:], place[span:])
        span *= 2
    rest = width - span
    best, place = join(best[: n], place[: n], best[rest : rest + n], place[rest : rest + n])
    return place


def paths(words: Words) -> Entries:
    """Compacted paths of a batch: ((minimizer, content), row, first word in the text, edges)."""
    start = window_starts(words, EDGE)
    if not len(start):
        return np.zeros((0, 2), np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    span = Spans(words.hashes())
    first = np.arange(len(words.row) - GRAM + 1)
    gram = span(first, first + GRAM)
    least = leftmost_least(gram, EDGE - GRAM + 1)[start]
    cut = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(start)]])
    a, n = start[cut[:-1]], np.diff(cut)
    keys = np.stack([gram[least[cut[:-1]]], span(a, a + n + EDGE - 1)], axis=1)
    row = words.row[a]
    return keys, row, a - words.first[row], n


def edges(words: Words, row: np.ndarray, start: np.ndarray, n: np.ndarray) -> Entries:
    """The single edges of given paths, by two independent hashes."""
    at = ranges(words.first[row] + start, n)
    hashes = words.hashes()
    keys = np.stack([Spans(hashes)(at, at + EDGE), Spans(mix(hashes + U(MIX_A)))(at, at + EDGE)], axis=1)
    row = np.repeat(row, n)
    return keys, row, at - words.first[row], np.ones(len(at), np.int64)


def settle(entries: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key and coordinate; the first entry of each key; which entries repeat it.
    Equal coordinates are one occurrence."""
    keys, docs, starts, _ = entries
    order = np.lexsort((starts, docs, keys[:, 1], keys[:, 0]))
    k, d, s = keys[order], docs[order], starts[order]
    fresh = np.concatenate([[True], (k[1:] != k[:-1]).any(axis=1)]) if len(k) else np.zeros(0, bool)
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(k) else np.zeros(0, np.int64)
    return order, first, (d != d[first]) | (s != s[first])


def found(kind: int, docs, starts, sizes, source_docs, source_starts) -> pa.RecordBatch:
    columns = (docs, starts, sizes, source_docs, source_starts)
    return pa.record_batch(
        [pa.array(np.full(len(docs), kind, np.int32)), *(pa.array(c, pa.int64()) for c in columns)],
        names=["kind", "doc_id", "start", "n", "source_doc", "source_start"],
    )


def send(held: list[Entries], count: int) -> Iterator[pa.RecordBatch]:
    """Packs entries by bucket: first occurrences to meet others, repeats as they are."""
    if not held:
        return
    entries = tuple(np.concatenate(x) for x in zip(*held))
    if not len(entries[1]):
        return
    order, first, again = settle(entries)
    keys, docs, starts, sizes = (x[order] for x in entries)
    source = np.stack([docs[first], starts[first]], axis=1).view(np.uint64)
    fresh = first == np.arange(len(first))
    out = []
    for kind, take in ((PATH, fresh), (REPEAT, again)):
        k = keys[take] if kind == PATH else source[take]
        d, s, n = docs[take], starts[take], sizes[take]
        by, at = shared.split_by_bucket((keys[take][:, 0] % U(count)).astype(np.int64), count)
        for b in np.flatnonzero(np.diff(at)):
            i = by[at[b] : at[b + 1]]
            out.append((int(b), kind, packed(k[i]), packed(d[i]), packed(s[i].astype(np.uint32)), packed(n[i].astype(np.uint16))))
    columns = list(zip(*out))
    yield pa.record_batch(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[2:])],
        names=[f.split()[0] for f in BLOBS.split(", ")],
    )


def scan(count: int, listed: bool):
    """Paths of all texts, or (``listed``) the edges of the paths listed with each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Entries] = []
        entries = 0
        for batch in batches:
            for part in slices(batch, "text"):
                ids = part.column(0).to_numpy().astype(np.int64)
                words = Words(part.column(1))
                if listed:
                    lists = part.column(2)
                    counts = np.diff(lists.offsets.to_numpy())
                    codes = lists.flatten().to_numpy().astype(np.int64)
                    row = np.repeat(np.arange(len(ids)), counts)
                    got = edges(words, row, codes >> 8, codes & 255)
                else:
                    got = paths(words)
                held.append((got[0], ids[got[1]], got[2], got[3]))
                entries += len(got[1])
                if entries > FLUSH:
                    yield from send(held, count)
                    held, entries = [], 0
        yield from send(held, count)

    return rows


def meet(branches: bool):
    """Per bucket: repeats; and (``branches``) first paths whose minimizer has several."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in shared.grouped_rows(batches, "bucket"):
            kinds = part.column("kind").to_numpy()
            for kind in (REPEAT, PATH):
                some = part.filter(pa.array(kinds == kind))
                keys = shared.joined(some.column("keys"), np.uint64).reshape(-1, 2)
                docs = shared.joined(some.column("docs"), np.int64)
                starts = shared.joined(some.column("starts"), np.uint32).astype(np.int64)
                sizes = shared.joined(some.column("sizes"), np.uint16).astype(np.int64)
                if not len(docs):
                    continue
                if kind == REPEAT:
                    source = keys.view(np.int64)
                    yield found(REPEAT, docs, starts, sizes, source[:, 0], source[:, 1])
                    continue
                order, first, again = settle((keys, docs, starts, sizes))
                k, d, s, n = keys[order], docs[order], starts[order], sizes[order]
                if again.any():
                    yield found(REPEAT, d[again], s[again], n[again], d[first[again]], s[first[again]])
                if branches:
                    fresh = np.flatnonzero(first == np.arange(len(first)))
                    m = k[fresh, 0]
                    same = m[1:] == m[:-1]
                    several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
                    take = fresh[several]
                    if len(take):
                        yield found(PATH, d[take], s[take], n[take], d[take], s[take])

    return rows


def codes(rows: DataFrame) -> DataFrame:
    """doc_id and its runs, each start * 256 + edges; a text's runs are as many as its words at most."""
    return rows.groupBy("doc_id").agg(F.collect_list(F.shiftleft("start", 8) + F.col("n")).alias("runs"))


def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves out the words under any listed run; what is kept, joined by spaces."""
    for batch in batches:
        for part in slices(batch, "text"):
            texts, lists = part.column(1).to_pylist(), part.column(2).to_pylist()
            total, gone, left = [], [], []
            for text, runs in zip(texts, lists):
                words = (text or "").encode().split()
                dropped = 0
                kept = words
                if runs:
                    run = np.array(runs, np.int64)
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, run >> 8, 1)
                    np.add.at(step, (run >> 8) + (run & 255) + EDGE - 1, -1)
                    keep = np.cumsum(step)[:-1] == 0
                    kept = compress(words, keep.tolist())
                    dropped = len(words) - int(keep.sum())
                total.append(len(words))
                gone.append(dropped)
                left.append(b" ".join(kept).decode())
            yield pa.record_batch(
                [part.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(left, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )


def documents(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, text) of the documents, under numbers in the order of ids, and their names
    (doc_id, id, copies). Where every row has an id and none repeats, the numbers are the ids
    and there are no names; else the documents are ranked by id (null last), then text, and
    stored, so that ranks stay."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    odd = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("doc_id is null or n > 1")
    if odd.isEmpty():
        # No row is lost; with the filter, both joins below have the same plan of the texts.
        return rows.filter("doc_id is not null"), None
    unlike = rows.withColumnRenamed("doc_id", "id").groupBy("id", "text").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("id").isNull(), F.coalesce("id", F.lit(0)), F.coalesce("text", F.lit("")), F.col("text").isNull())
    path = scratch(docs.sparkSession, "documents")
    add_rank(unlike, [order], "doc_id").write.parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    return stored.select("doc_id", "text").filter("doc_id is not null"), stored.select("doc_id", "id", "copies")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, start, n (edges; the run covers n + 19 words), source_doc, source_start: runs
    of words that start earlier elsewhere, at the source; numbers as in ``documents``."""
    return runs_of(documents(docs)[0])


def runs_of(rows: DataFrame) -> DataFrame:
    count = shared.buckets(rows.sparkSession)
    met = shared.exchange(rows.mapInArrow(scan(count, False), BLOBS)).mapInArrow(meet(True), FOUND)
    met = shared.cut_lineage(met)
    listed = rows.join(codes(met.filter(F.col("kind") == PATH)), "doc_id").select("doc_id", "text", "runs")
    single = shared.exchange(listed.mapInArrow(scan(count, True), BLOBS)).mapInArrow(meet(False), FOUND)
    return met.filter(F.col("kind") == REPEAT).unionAll(single).drop("kind")


def kept_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the text left)."""
    rows, names = documents(docs)
    joined = rows.join(codes(runs_of(rows)), "doc_id", "left").select("doc_id", "text", "runs")
    left = joined.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept string")
    if names is None:
        return left
    each = left.join(names, "doc_id").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return kept_texts(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
