"""Packing by Karmarkar-Karp multiway differencing.

Each task packs its own documents; nothing is shuffled. A document's ids fill whole windows
first; what remains is cut into pieces of at most ``PIECE`` ids. Pieces of about ``POOL``
windows are dealt to k windows: every piece begins as a partition of its own, and the two
partitions of greatest imbalance merge, the largest sums of one with the smallest of the
other, until one is left. Its windows are nearly equal. k begins at the least possible
number; while a window exceeds the capacity, k rises by one and the pool is dealt again.

Nulls and odd rows: a null or empty text is its end id alone; repeated rows are packed
once each; a row without id keeps its null id; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindscope.llm.encode import Encoder
from bindscope.llm.tokens import slices

PIECE, POOL = 256, 64
RESULT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long"
)


def differencing(lengths: np.ndarray, k: int) -> list[list[int]]:
    """Items of each of ``k`` nearly equal sums."""
    parts: dict[int, tuple[int, int]] = {}
    heap = []
    for i, n in enumerate(lengths.tolist()):
        sums = np.zeros(k, np.int64)
        nodes = np.full(k, -1, np.int64)
        sums[0], nodes[0] = n, i
        heap.append((-n if k > 1 else 0, i, sums, nodes))
    heapq.heapify(heap)
    fresh = count = len(lengths)
    while len(heap) > 1:
        _, _, s1, n1 = heapq.heappop(heap)
        _, _, s2, n2 = heapq.heappop(heap)
        sums = s1 + s2[::-1]
        n2 = n2[::-1]
        nodes = np.where(n1 < 0, n2, n1)
        for j in np.flatnonzero((n1 >= 0) & (n2 >= 0)):
            parts[fresh] = (int(n1[j]), int(n2[j]))
            nodes[j] = fresh
            fresh += 1
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        count += 1
        heapq.heappush(heap, (int(sums[-1] - sums[0]), count, sums, nodes))
    out = []
    for node in heap[0][3].tolist():
        items, stack = [], [node] if node >= 0 else []
        while stack:
            x = stack.pop()
            if x < len(lengths):
                items.append(x)
            else:
                stack.extend(parts[x])
        out.append(items)
    return [x for x in out if x]


def deal(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    k = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        windows = differencing(lengths, k)
        if max(int(lengths[w].sum()) for w in windows) <= capacity:
            return windows
        k += 1


def padded(length: int, capacity: int) -> int:
    """The length that a sequence is stored with."""
    return length if length & (length - 1) == 0 else capacity


def packer(path: str, end: int, capacity: int, with_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        sequence = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        pool: list[tuple] = []
        waiting = 0

        def piece(doc, ids, start, length, number, offset, whole) -> tuple:
            raw = ids[start : start + length].astype("<u4").tobytes()
            return (doc, start, length, zlib.crc32(raw), len(ids), number, offset, padded(whole, capacity), raw)

        def flush() -> None:
            nonlocal sequence, waiting
            if pool:
                for window in deal(np.array([p[3] for p in pool]), capacity):
                    offset, whole = 0, sum(pool[i][3] for i in window)
                    for i in window:
                        doc, ids, start, length = pool[i]
                        out.append(piece(doc, ids, start, length, sequence, offset, whole))
                        offset += length
                    sequence += 1
            pool.clear()
            waiting = 0

        def result() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            arrays = [pa.array(c, pa.int64()) for c in columns[:8]]
            names = [f.split()[0] for f in RESULT.split(", ")]
            if with_ids:
                arrays.append(pa.array(columns[8], pa.binary()))
                names.append("ids")
            return pa.record_batch(arrays, names=names)

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                docs = part.column(0).to_pylist()
                for doc, ids in zip(docs, encoder.encode(part.column(1).to_pylist(), end)):
                    full = len(ids) // capacity * capacity
                    for start in range(0, full, capacity):
                        out.append(piece(doc, ids, start, capacity, sequence, 0, capacity))
                        sequence += 1
                    left = len(ids) - full
                    cuts = np.linspace(0, left, -(-left // PIECE) + 1).astype(int) + full if left else []
                    for a, b in zip(cuts[:-1], cuts[1:]):
                        pool.append((doc, ids, int(a), int(b - a)))
                    waiting += left
                    if waiting >= POOL * capacity:
                        flush()
                if out:
                    yield result()
        flush()
        if out:
            yield result()

    return rows


def pack(docs: DataFrame, path: str, end: int = 0, capacity: int = 1024, with_ids: bool = True) -> DataFrame:
    """One row per piece: its document and place there, its sequence and place there, the
    length its sequence is stored with, and (``with_ids``) its ids as little-endian 32-bit
    numbers. ``path``: a file of the tokenizers library that every executor has."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(packer(path, end, capacity, with_ids), RESULT + (", ids binary" if with_ids else ""))
