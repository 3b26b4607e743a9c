"""N-gram Jaccard join as a blocked sparse product of the document by n-gram matrix.

A document's row is its set of distinct word n-grams; two documents link when
``100 * |A & B| >= threshold * |A | B|``. The product of the matrix with its transpose
holds all overlaps. It is never formed whole:

1. *Column blocks.* A linked pair differs in at most D n-grams, a bound that follows from
   the smaller size. Every row is cut by n-gram hash into more than D column blocks, so a
   linked pair agrees in a whole non-empty block. Pairs that agree in none are discarded
   unmultiplied. Sizes are grouped in levels, and a row is cut for each level in which a
   partner may lie. Where a row leaves too many blocks empty to prove the agreement, it is
   cut again, finer (``Cuts``). Block hashes travel packed, one shuffle for all of them. Of rows
   with equal sets only one is cut. Up to ``FEW`` rows of equal block are listed as pairs.
2. *Rarest columns.* Short blocks may lie in a passage that many documents share. So the rows
   of larger blocks are ordered by column weight (a sketch of ``SKETCH`` counters, whatever the
   input), and only their first |A| - need + 1 columns count: a linked pair has one of them in
   common. The order may be any; a coarse sketch costs time, not links. Columns of one row are
   left out; up to ``FEW`` rows of one column are pairs again, more are linked unseen.
3. *Parities.* A listed pair stays if the parities of its columns, counted in as many cells as
   the row has n-grams, differ in no more cells than the bound lets n-grams differ. So what is
   joined by chance falls out before any text moves, and can't chain groups together.
4. *Row blocks.* The pairs left form groups; a group's rows are cut into
   blocks of bounded size, and one task multiplies two row blocks. It adds up overlaps over
   column tiles and drops a pair as soon as its overlap and what is left of its rows can't
   reach the bound. It returns a spanning forest of the links, not the pairs.
5. Groups of several row blocks first meet pivots (a few rows of the group) only; then the
   rows that did not join the largest component meet all rows.

Rows with equal sets collapse before the product. Every linked pair is found or joined by
links that are found; nothing is capped.

Nulls and odd rows: a row without id is not a document and is left out; a null, empty or
wordless text has no n-grams, links with nothing and is its own component; repeated rows
each return a row. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindscope.llm import shared
from bindscope.llm.tokens import MIX_A, MIX_B, U, Spans, Words, mix, mix1, packed, slices
from bindscope.session import scratch

ROW_BLOCK = 256
BLOCK_GRAMS = 1 << 20
TILE = 2048
FLUSH = 1 << 20
#: Text bytes that are hashed at once: a worker's arrays take some 60 times as many.
SLICE = 1 << 20
SKETCH = 1 << 22
#: Most rows of equal block or column that are listed pair by pair.
FEW = 16
#: Bits of the sieve that keeps documents without candidates in place; those of one bitmap.
SIEVE, BITMAP = 1 << 25, 1 << 15
#: Kinds of exchanged and returned rows.
SIZE, SAME, CANDIDATE, MANY = 0, 1, 2, 3
KEY = "__key"
BLOBS = "bucket int, kind int, keys binary, ids binary"
MET = "kind int, a long, b long, cells binary"


def gram_sets(column: pa.Array, n: int) -> tuple[list[np.ndarray], Words]:
    """Sorted distinct n-gram hashes of each text; a text of fewer words has one n-gram."""
    words = Words(column, lower=True)
    span = Spans(words.hashes())
    room = np.where(words.count >= n, words.count - n + 1, np.minimum(words.count, 1))
    bounds = np.concatenate([[0], np.cumsum(room)])
    start = np.repeat(words.first[:-1] - bounds[:-1], room) + np.arange(bounds[-1])
    width = np.repeat(np.minimum(words.count, n), room)
    hashes = span(start, start + width)
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], words


def cells(size: int) -> int:
    """Parity cells of a row: a power of two, 64 or more, at least one for each n-gram."""
    return 1 << max(6, (size - 1).bit_length())


def parities(grams: np.ndarray) -> bytes:
    """Whether each cell holds an odd number of the row's n-grams, packed."""
    n = cells(len(grams))
    odd = np.bincount((grams & U(n - 1)).astype(np.int64), minlength=n) & 1
    return packed(np.packbits(odd.astype(np.uint8), bitorder="little"))


def may_link(threshold: int):
    """Candidate pairs (a, b, sizes m and n, parities p and q) that can still link."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in "mn")
            need = -(-threshold * (m + n) // (100 + threshold))
            kept = np.minimum(m, n) >= need
            differ = m + n - 2 * need
            p, q = (batch.column(batch.schema.get_field_index(c)) for c in "pq")
            for i in np.flatnonzero(kept):
                x, y = (np.frombuffer(c[i].as_buffer(), np.uint8) for c in (p, q))
                # An n-gram of both rows changes no cell, one of a single row changes one.
                width = min(len(x), len(y))
                x, y = (np.bitwise_xor.reduce(c.reshape(-1, width), axis=0) for c in (x, y))
                kept[i] = int(np.bitwise_count(x ^ y).sum()) <= differ[i]
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    return rows


class Cuts:
    """Column blocks of a row, by its size."""

    def __init__(self, threshold: int):
        if not 67 <= threshold <= 100:
            raise ValueError("threshold must be 67 to 100: below, blocks of single n-grams can't prove agreement")
        self.t = threshold
        self.cached: dict[int, list[tuple[int, int, int]]] = {}

    def level(self, size: int) -> tuple[int, int]:
        """The level's bounds: sizes low..high lie in it."""
        low = 1
        while True:
            high = max(low, low * 3 // 2 - 1)
            if size <= high:
                return low, high
            low = high + 1

    def levels(self, size: int) -> list[tuple[int, int, int]]:
        """(level, most differing n-grams, empty blocks allowed first) of each cut."""
        if size not in self.cached:
            out, at = [], self.level(-(-self.t * size // 100))
            while at[0] <= size:
                differ = (100 - self.t) * at[1] // self.t
                spare = 0
                while spare <= differ and (differ + 1 + spare) * math.exp(-at[0] / (differ + 1 + spare)) > 0.8 * spare + 0.1:
                    spare += 1
                if differ:  # else linked rows are equal
                    out.append((at[0], differ, spare))
                at = self.level(at[1] + 1)
            self.cached[size] = out
        return self.cached[size]

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """Hashes of the row's non-empty column blocks."""
        out = []
        values = grams >> U(32)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams + U(MIX_A)))])
        for level, differ, spare in self.levels(len(grams)):
            while True:
                # Both rows of a pair are cut up to the round in which one has at most
                # ``spare`` empty blocks: there, more than ``differ`` blocks hold n-grams.
                count = differ + 1 + spare
                block = (values * U(count)) >> U(32)
                edge = np.flatnonzero(block[1:] != block[:-1]) + 1
                start = np.concatenate([[0], edge])
                end = np.concatenate([edge, [len(grams)]])
                salt = mix1(level * MIX_B + count)
                out.append(mix(mix((total[end] - total[start]) + U(salt)) + block[start]))
                if count - len(start) <= spare:
                    break
                spare = 2 * spare + 1
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def set_key(grams: np.ndarray) -> tuple[int, int, int]:
    """Size and two hashes of a row's set."""
    return len(grams), int(np.sum(mix(grams + U(MIX_B)))), int(np.sum(grams * grams))


def measure(n: int, count: int):
    """Sizes and parities of the rows, and the keys of their sets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[int, list] = {SIZE: [], SAME: [], CANDIDATE: []}
            for part in slices(batch, "text", SLICE):
                ids = part.column(0).to_numpy().astype(np.int64)
                sets, _ = gram_sets(part.column(1), n)
                held[SIZE].append((ids, np.array([len(g) for g in sets], np.int64), b"".join(map(parities, sets))))
                held[SAME] += [(np.array(set_key(g), np.uint64), i) for i, g in zip(ids, sets) if len(g)]
            yield from blobs(held, count)

    return rows


def scan(n: int, threshold: int, count: int):
    """The column blocks of the rows, once for each set of a batch."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = Cuts(threshold)
        for batch in batches:
            held: dict[int, list] = {SIZE: [], SAME: [], CANDIDATE: []}
            seen: set[tuple[int, int, int]] = set()
            entries = 0
            for part in slices(batch, "text", SLICE):
                ids = part.column(0).to_numpy().astype(np.int64)
                for i, grams in zip(ids, gram_sets(part.column(1), n)[0]):
                    if not len(grams):
                        continue
                    key = set_key(grams)
                    if key not in seen:
                        seen.add(key)
                        keys = cuts.keys(grams)
                        held[CANDIDATE].append((keys, np.full(len(keys), i)))
                        entries += len(keys)
                if entries > FLUSH:
                    yield from blobs(held, count)
                    held = {SIZE: [], SAME: [], CANDIDATE: []}
                    entries = 0
            yield from blobs(held, count)

    return rows


def blobs(held: dict[int, list], count: int) -> Iterator[pa.RecordBatch]:
    out: list[tuple[int, int, bytes, bytes]] = []
    if held[SIZE]:
        ids = np.concatenate([a for a, _, _ in held[SIZE]])
        sizes = np.concatenate([b for _, b, _ in held[SIZE]])
        if len(ids):
            out.append((int(mix1(int(ids[0])) % count), SIZE, packed(ids), packed(sizes) + b"".join(c for _, _, c in held[SIZE])))
    if held[SAME]:
        keys = np.stack([k for k, _ in held[SAME]])
        ids = np.array([i for _, i in held[SAME]], np.int64)
        order, at = shared.split_by_bucket((mix(keys[:, 1]) % U(count)).astype(np.int64), count)
        for b in np.flatnonzero(np.diff(at)):
            take = order[at[b] : at[b + 1]]
            out.append((int(b), SAME, packed(keys[take]), packed(ids[take])))
    if held[CANDIDATE]:
        keys = np.concatenate([k for k, _ in held[CANDIDATE]])
        ids = np.concatenate([i for _, i in held[CANDIDATE]])
        order, at = shared.split_by_bucket((keys % U(count)).astype(np.int64), count)
        keys, ids = keys[order], ids[order]
        # 32 bits of a key are enough within its bucket: false candidates cost time only. Ids
        # of one row share their high bits.
        short = ((keys // U(count)) & U(0xFFFFFFFF)).astype(np.uint32)
        for b in np.flatnonzero(np.diff(at)):
            k, i = short[at[b] : at[b + 1]], ids[at[b] : at[b + 1]]
            for high in np.unique(i >> 31):
                own = i >> 31 == high
                out.append((int(b), CANDIDATE, packed(k[own]), packed(high) + packed((i[own] & (2**31 - 1)).astype(np.uint32))))
    if out:
        bucket, kind, k, i = zip(*out)
        yield pa.record_batch(
            [pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(k, pa.binary()), pa.array(i, pa.binary())],
            names=["bucket", "kind", "keys", "ids"],
        )


def stars(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each id to the smallest id of its key; ``keys`` of one or more columns."""
    columns = (ids, keys) if keys.ndim == 1 else (ids, *keys.T)
    order = np.lexsort(columns)
    keys, ids = keys[order], ids[order]
    fresh = keys[1:] != keys[:-1]
    fresh = np.concatenate([[True], fresh if keys.ndim == 1 else fresh.any(axis=1)])
    centre = ids[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    link = ids != centre
    pair = np.unique(np.stack([ids[link], centre[link]]), axis=1)
    return pair[0], pair[1]


def some_pairs(keys: np.ndarray, ids: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """All pairs of the ids of a key that has up to ``FEW``, and the stars of larger ones."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    few = np.repeat(np.diff(at) <= FEW, np.diff(at))
    many = stars(keys[~few], ids[~few]) if not few.all() else (ids[:0], ids[:0])
    keys, ids = keys[few], ids[few]
    found = [np.zeros((2, 0), np.int64)]
    for step in range(1, FEW):
        hit = np.flatnonzero((keys[step:] == keys[:-step]) & (ids[step:] != ids[:-step]))
        if not len(hit):
            break
        found.append(np.stack([ids[hit + step], ids[hit]]))
    pair = np.unique(np.concatenate(found, axis=1), axis=1)
    return (pair[0], pair[1]), many


def met_rows(kind: int, a: np.ndarray, b: np.ndarray, held: list[bytes] | None = None) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(a), kind, np.int32)), pa.array(a, pa.int64()), pa.array(b, pa.int64())]
    columns.append(pa.array(held, pa.binary()) if held is not None else pa.nulls(len(a), pa.binary()))
    return pa.record_batch(columns, names=["kind", "a", "b", "cells"])


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: sizes and parities as they are, stars of rows with equal sets, pairs or
    stars of rows with equal blocks."""
    for _, rows in shared.grouped_rows(batches, "bucket"):
        kinds = rows.column("kind").to_numpy()
        for kind in np.unique(kinds):
            part = rows.filter(pa.array(kinds == kind))
            if kind == SIZE:
                for own, rest in zip(part.column("keys").to_pylist(), part.column("ids").to_pylist()):
                    ids = np.frombuffer(own, np.int64)
                    sizes = np.frombuffer(rest, np.int64, len(ids))
                    end = len(own) + np.cumsum([cells(int(x)) // 8 for x in sizes])
                    yield met_rows(SIZE, ids, sizes, [rest[a:b] for a, b in zip([len(own), *end[:-1]], end)])
            elif kind == SAME:
                ids, keys = shared.joined(part.column("ids"), np.int64), shared.joined(part.column("keys"), np.uint64)
                yield met_rows(SAME, *stars(keys.reshape(len(ids), -1), ids))
            else:
                keys = shared.joined(part.column("keys"), np.uint32)
                ids = np.concatenate([
                    (np.frombuffer(x, np.int64, 1)[0] << 31) + np.frombuffer(x, np.uint32, offset=8).astype(np.int64) for x in part.column("ids").to_pylist()
                ])
                few, many = some_pairs(keys, ids)
                yield met_rows(CANDIDATE, *few)
                yield met_rows(MANY, *many)


def multiply(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: int) -> np.ndarray:
    """Which rows of ``left`` link with which of ``right`` (numbers into ``sets``)."""
    size = np.array([len(s) for s in sets], np.int64)
    need = -(-threshold * (size[left][:, None] + size[right][None, :]) // (100 + threshold))
    live = np.minimum(size[left][:, None], size[right][None, :]) >= need
    live &= left[:, None] != right[None, :]
    overlap = np.zeros(need.shape, np.float32)
    if not live.any():
        return live
    gram, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    common = np.bincount(column, minlength=len(gram)) > 1  # a gram of one row overlaps with none
    number = np.cumsum(common) - 1
    kept = common[column]
    row, column = row[kept], number[column[kept]]
    left_over = np.bincount(row, minlength=len(sets))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    edges = np.searchsorted(column, np.arange(0, int(common.sum()) + TILE, TILE))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        l, r = np.flatnonzero(live.any(axis=1)), np.flatnonzero(live.any(axis=0))
        if not len(l):
            break
        tile = np.zeros((len(sets), TILE), np.float32)
        tile[row[a:b], column[a:b] - k * TILE] = 1
        overlap[np.ix_(l, r)] += tile[left[l]] @ tile[right[r]].T
        left_over = left_over - np.bincount(row[a:b], minlength=len(sets))
        live &= overlap + np.minimum(left_over[left][:, None], left_over[right][None, :]) >= need
    return live & (overlap >= need)


def forest(ids: np.ndarray, left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each row to the first row of its component."""
    a, b = np.nonzero(linked)
    a, b = left[a], right[b]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(ids[label] != ids)
    return ids[moved], ids[label[moved]]


def product(n: int, threshold: int):
    """One task's row blocks (sorted by ``task``; side 1: left, 2: right, 3: both)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in shared.grouped_rows(batches, "task"):
            sets = [g for some in slices(part, "text", SLICE) for g in gram_sets(some.column("text"), n)[0]]
            ids, side = part.column("doc_id").to_numpy(), part.column("side").to_numpy()
            left, right = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
            if len(left) and len(right):
                a, b = forest(ids, left, right, multiply(sets, left, right, threshold))
                if len(a):
                    yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows


def multiplied(rows: DataFrame, n: int, threshold: int) -> DataFrame:
    """rows: task, side, doc_id, text."""
    parts = shared.partitions(rows.sparkSession)
    dealt = rows.select("task", "side", "doc_id", "text").repartition(parts, "task").sortWithinPartitions("task")
    return dealt.mapInArrow(product(n, threshold), "a long, b long")


def block(col: str, count: str) -> F.Column:
    return F.pmod(F.xxhash64(col, F.lit(7)), F.col(count))


def jaccard_components(docs: DataFrame, n: int = 3, threshold: int = 90, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles (size of the set), component_id (smallest id reachable by links)."""
    spark = docs.sparkSession
    count = shared.buckets(spark)
    input_rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).filter("doc_id is not null")
    met = shared.cut_lineage(shared.exchange(input_rows.mapInArrow(measure(n, count), BLOBS)).mapInArrow(meet, MET))
    sizes = met.filter(F.col("kind") == SIZE).select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"), "cells")
    same = met.filter(F.col("kind") == SAME).select("a", "b")
    # Copies agree in all blocks: only one row of a set is cut.
    lone = marked(input_rows, first_rows(sizes, same)).filter("__likely").select("doc_id", "text")
    found = shared.exchange(lone.mapInArrow(scan(n, threshold, count), BLOBS)).mapInArrow(meet, MET)
    # A pair that agrees in blocks of many buckets is kept once.
    agreed = shared.cut_lineage(found.select("kind", "a", "b").distinct())
    links = same
    if not agreed.isEmpty():
        links = same.unionAll(block_links(input_rows, agreed, same, sizes, n, threshold))
    reached = shared.components(links).select(F.col("node").alias("doc_id"), "component")
    return sizes.join(reached, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def first_rows(sizes: DataFrame, same: DataFrame) -> DataFrame:
    """doc_id of the rows with n-grams that are the first of their set, and of all rows whose
    id repeats, as their sets may differ."""
    told = sizes.filter("n_shingles > 0").select("doc_id", F.lit(1).alias("rows"), F.lit(0).alias("copy"))
    told = told.unionAll(same.select("a", F.lit(0), F.lit(1)))
    return told.groupBy("doc_id").agg(F.sum("rows").alias("rows"), F.max("copy").alias("copy")).filter("rows > 1 or copy = 0").select("doc_id")


def weigh(n: int, count: int):
    """A task's column weights, packed by counter range: counter numbers and counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                for grams in gram_sets(part.column(1), n)[0]:
                    np.add.at(weight, (grams & U(SKETCH - 1)).astype(np.int64), 1)
        used = np.flatnonzero(weight)
        at = np.searchsorted(used, np.arange(count + 1) * SKETCH // count)
        full = np.flatnonzero(np.diff(at))
        yield pa.record_batch(
            [pa.array(full, pa.int32()), pa.array(np.zeros(len(full)), pa.int32()),
             pa.array([packed(used[at[b] : at[b + 1]].astype(np.uint32)) for b in full], pa.binary()),
             pa.array([packed(np.minimum(weight[used[at[b] : at[b + 1]]], 255).astype(np.uint8)) for b in full], pa.binary())],
            names=["bucket", "kind", "keys", "ids"],
        )

    return rows


def add_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the counters of each range, at most 255 each."""
    for _, part in shared.grouped_rows(batches, "bucket"):
        keys, counts = shared.joined(part.column("keys"), np.uint32), shared.joined(part.column("ids"), np.uint8)
        low = int(keys.min())
        total = np.bincount(keys - low, counts)
        yield pa.record_batch([pa.array([low], pa.int64()), pa.array([packed(np.minimum(total, 255).astype(np.uint8))], pa.binary())], names=["low", "weights"])


def rarest(n: int, threshold: int, count: int, weight):
    """Each row's rarest columns that it may share, packed by column."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[int, list] = {SIZE: [], SAME: [], CANDIDATE: []}
            for part in slices(batch, "text", SLICE):
                for i, grams in zip(part.column(0).to_numpy(), gram_sets(part.column(1), n)[0]):
                    w = weight.value[(grams & U(SKETCH - 1)).astype(np.int64)]
                    first = np.lexsort((grams, w))[: len(grams) + threshold * len(grams) // -100 + 1]
                    keys = grams[first[w[first] > 1]]
                    held[CANDIDATE].append((keys, np.full(len(keys), i)))
            yield from blobs(held, count)

    return rows


def shared_columns(rows: DataFrame, n: int, threshold: int) -> DataFrame:
    """Pairs and stars (kind, a, b) of the rows that share one of their rarest columns."""
    spark = rows.sparkSession
    count = shared.buckets(spark)
    weight = np.zeros(SKETCH, np.uint8)
    # The driver gets and broadcasts SKETCH bytes, whatever the input.
    for r in shared.exchange(rows.mapInArrow(weigh(n, count), BLOBS)).mapInArrow(add_weights, "low long, weights binary").toLocalIterator():
        part = np.frombuffer(r.weights, np.uint8)
        weight[r.low : r.low + len(part)] = part
    found = rows.mapInArrow(rarest(n, threshold, count, spark.sparkContext.broadcast(weight)), BLOBS)
    return shared.cut_lineage(shared.exchange(found).mapInArrow(meet, MET).select("kind", "a", "b"))


def bounded(pairs: DataFrame, sizes: DataFrame, threshold: int) -> DataFrame:
    """The distinct pairs that sizes and parities don't rule out."""
    left, right = (sizes.select(F.col("doc_id").alias(i), F.col("n_shingles").alias(s), F.col("cells").alias(c)) for i, s, c in ("amp", "bnq"))
    sized = pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().join(left, "a").join(right, "b")
    return shared.cut_lineage(sized.mapInArrow(may_link(threshold), "a long, b long").distinct())


def marked(docs: DataFrame, ids: DataFrame, key: str = "doc_id", flag: str = "__likely") -> DataFrame:
    """``docs`` with ``flag``: false for most rows that ``ids`` doesn't name, true for all
    that it names, by one bitmap of ``SIEVE`` bits, whatever the input."""
    place = F.pmod(F.xxhash64(key), F.lit(SIEVE))
    at, bit = F.floor(place / BITMAP).alias("__at"), place % BITMAP
    maps = ids.groupBy(at).agg(F.bitmap_construct_agg(bit).alias("__bits"))
    cell = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # At most SIEVE / BITMAP rows of 4 kB: the bound that lets it be broadcast.
    found = docs.withColumn("__at", at).join(F.broadcast(maps), "__at", "left")
    return found.withColumn(flag, F.coalesce(F.getbit(cell, (bit % 8).cast("int")) == 1, F.lit(False))).drop("__at", "__bits")


def sifted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``ids`` names; most others stay where they are."""
    return marked(docs, ids).filter("__likely").drop("__likely").join(ids, "doc_id")


def block_links(docs: DataFrame, agreed: DataFrame, same: DataFrame, sizes: DataFrame, n: int, threshold: int) -> DataFrame:
    """Links among the documents that agree with another in a block."""
    spark = docs.sparkSession
    first_of = same.select("a", F.col("b").alias("first")).distinct()

    def lead(frame: DataFrame, col: str) -> DataFrame:
        """``col`` becomes the first of the rows of equal set."""
        return frame.join(first_of.withColumnRenamed("a", col), col, "left").withColumn(col, F.coalesce("first", col)).drop("first")

    pairs = bounded(lead(lead(agreed.filter(F.col("kind") == CANDIDATE).select("a", "b"), "a"), "b"), sizes, threshold)
    many = agreed.filter(F.col("kind") == MANY)
    many = lead(many.select(F.col("a").alias("doc_id")).unionAll(many.select("b")).distinct(), "doc_id")
    nodes = pairs.select(F.col("a").alias("doc_id"), F.lit(False).alias("many")).unionAll(pairs.select("b", F.lit(False)))
    chosen = shared.cut_lineage(nodes.unionAll(many.select("doc_id", F.lit(True))).groupBy("doc_id").agg(F.max("many").alias("many")))
    if chosen.isEmpty():
        return pairs
    texts = scratch(spark, "ngram-rows")
    sifted(docs, chosen).select("doc_id", "text", "many").write.parquet(texts)
    docs = spark.read.parquet(texts)
    edges = pairs
    if not many.isEmpty():
        columns = shared_columns(docs.filter("many").select("doc_id", "text"), n, threshold)
        listed = columns.filter(F.col("kind") == CANDIDATE).select("a", "b")
        edges = edges.unionAll(bounded(listed, sizes, threshold)).unionAll(columns.filter(F.col("kind") == MANY).select("a", "b"))
    groups = shared.components(edges)
    members = groups.select(F.col("node").alias("doc_id"), F.col("component").alias("group"))
    volume = members.join(sizes, "doc_id").groupBy("group").agg(
        F.count(F.lit(1)).alias("rows"),
        F.greatest(F.ceil(F.count(F.lit(1)) / ROW_BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_GRAMS)).cast("long").alias("blocks"),
    ).filter("rows > 1")
    members = shared.cut_lineage(members.join(volume, "group"))
    rows = members.join(docs, "doc_id")
    one = rows.filter("blocks = 1").select(F.col("group").alias("task"), F.lit(3).alias("side"), "doc_id", "text")
    links = shared.cut_lineage(multiplied(one, n, threshold))
    if members.filter("blocks > 1").isEmpty():
        return links
    many = rows.filter("blocks > 1")
    # Pivots: about 16 rows a group, chosen by hash, and the group's smallest id.
    picked = (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.col("rows")) < 16) | (F.col("doc_id") == F.col("group"))
    task = F.xxhash64("group", "i", "j")
    placed = many.withColumn("i", block("doc_id", "blocks")).withColumn("j", F.lit(-1)).withColumn("side", F.lit(2))
    pivots = many.filter(picked).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("j", F.lit(-1)).withColumn("side", F.lit(1))
    first = shared.cut_lineage(multiplied(placed.unionByName(pivots).withColumn("task", task), n, threshold))
    label = shared.components(first).select(F.col("node").alias("doc_id"), F.col("component").alias("label"))
    ids = many.select("doc_id", "group").join(label, "doc_id", "left").select("doc_id", "group", F.coalesce("label", "doc_id").alias("label"))
    main = ids.groupBy("group", "label").count().groupBy("group").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    rest = shared.cut_lineage(ids.join(main, "group").filter("label <> main").select("doc_id", "group"))
    if rest.isEmpty():
        return links.unionAll(first)
    strips = rest.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / ROW_BLOCK).cast("long").alias("strips"))
    everyone = (
        many.join(strips, "group").withColumn("j", block("doc_id", "blocks"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("strips") - 1))).withColumn("side", F.lit(2))
    )
    left = (
        many.join(rest.select("doc_id"), "doc_id", "left_semi").join(strips, "group").withColumn("i", block("doc_id", "strips"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(1))
    )
    second = shared.cut_lineage(multiplied(everyone.unionByName(left).withColumn("task", task), n, threshold))
    return links.unionAll(first).unionAll(second)


def keep_one(docs: DataFrame, n: int = 5, threshold: int = 80) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id, rows without id
    last. Of rows without words, one for each (doc_id, text). Rows are told apart by a key of
    their own, so rows without id and rows that repeat an id are compared like all others."""
    rows = shared.keyed(docs, KEY)
    found = jaccard_components(rows, n, threshold, doc=KEY).select(F.col("doc_id").alias(KEY), "n_shingles", "component_id")
    text, own = F.col("text").cast("string"), F.col("doc_id").cast("long")
    place = F.struct(own.isNull().alias("none"), own.alias("id"), F.col(KEY).alias("key"))
    grouped = found.filter("n_shingles > 0").join(rows.select(KEY, "doc_id"), KEY)
    first = grouped.groupBy("component_id").agg(F.min(place)["key"].alias("__first"))
    copies = grouped.join(first, "component_id").filter(F.col(KEY) != F.col("__first")).select(KEY)
    wordless = rows.filter(~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    alone = wordless.groupBy("doc_id", text.alias("text")).agg(F.min(KEY).alias(KEY)).select(KEY)
    dropped = shared.cut_lineage(copies.unionAll(wordless.select(KEY).join(alone, KEY, "left_anti")))
    return without(rows, dropped, KEY).select(docs.columns)


def without(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key``, not null, is not in ``dropped``. A row is dropped or it stays, so
    a bitmap of each decides most rows in place; only those in both are exchanged."""
    stays = rows.select(key).join(dropped, key, "left_anti")
    told = marked(marked(rows, dropped, key), stays, key, "__stays")
    kept = told.filter("__stays and not __likely").unionByName(told.filter("__stays and __likely").join(dropped, key, "left_anti"))
    return kept.drop("__likely", "__stays")
