"""Vectorised words and word hashes over Arrow text columns.

A batch is the UTF-8 bytes of many texts and their row offsets. Word hashes are
polynomial over bytes, modulo 2^64, then mixed, so equal words have equal hashes in any
batch, and different ones collide with a chance of 2^-64 each pair. (Only words made for
that purpose, of over a thousand letters, can collide by design.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Odd multipliers of the two polynomials, and the mixer's constants.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(MIX_A)
    x = x ^ (x >> U(27))
    x = x * U(MIX_B)
    return x ^ (x >> U(31))


def mix1(x: int) -> int:
    return int(mix(np.array([x & (2**64 - 1)], dtype=np.uint64))[0])


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and their inverses modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 16)
        inverse = pow(base, -1, 2**64)
        have = tuple(
            np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size, b, np.uint64))])
            for b in (base, inverse)
        )
        _POWERS[base] = have
    return have


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows of about ``limit`` text bytes, at least one row each."""
    if batch.num_rows == 0:
        return
    _, at = text_bytes(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(at, at[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


class Words:
    """Words of a batch of texts: ``start``/``end`` byte positions, ``first`` word number
    of each row (and, as its last entry, the number of all words)."""

    def __init__(self, column: pa.Array, lower: bool = False, space: np.ndarray = SPACE):
        data, self.at = text_bytes(column)
        self.data = LOWER[data] if lower else data
        inside = ~space[self.data]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        before[:1] = False
        rows = self.at[:-1]
        before[rows[rows < len(data)]] = False
        self.start = np.flatnonzero(inside & ~before)
        last = np.empty_like(inside)
        last[:-1] = ~inside[1:] | (~before[1:] & inside[1:])
        last[-1:] = True
        self.end = np.flatnonzero(inside & last) + 1
        self.first = np.searchsorted(self.start, self.at)
        self.rows = len(self.at) - 1
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(self.rows), self.count)

    def hashes(self) -> np.ndarray:
        p, inverse = powers(BYTE_BASE, len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + U(1)) * p[: len(self.data)], out=total[1:])
        h = (total[self.end] - total[self.start]) * inverse[self.start]
        return mix(h + U(WORD_BASE) * (self.end - self.start).astype(np.uint64))


class Spans:
    """Hashes of any runs of consecutive words."""

    def __init__(self, hashes: np.ndarray):
        p, self.inverse = powers(WORD_BASE, len(hashes) + 1)
        self.total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * p[: len(hashes)], out=self.total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.total[end] - self.total[start]) * self.inverse[start]
        return mix(h + U(BYTE_BASE) * (end - start).astype(np.uint64))


def window_starts(words: Words, width: int) -> np.ndarray:
    """Word numbers at which ``width`` consecutive words of one row begin."""
    room = np.maximum(words.count - width + 1, 0)
    if not room.sum():
        return np.zeros(0, np.int64)
    return ranges(words.first[:-1], room)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ..., then start[1], ...: ``length[i]`` numbers from each."""
    total = int(length.sum())
    shift = np.repeat(start - (np.cumsum(length) - length), length)
    return shift + np.arange(total)


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()
