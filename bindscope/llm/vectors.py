"""Vectors of a list column as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def doubles(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector as an array of doubles); all other columns are left out."""
    return df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))


def usable(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose vector has entries, none of them null, NaN or infinite: row numbers,
    lengths, and the entries of these rows one after the other."""
    column = batch.column(batch.schema.get_field_index("vector"))
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry becomes NaN
    owner = np.repeat(np.arange(batch.num_rows), sizes)
    bad = np.zeros(batch.num_rows, bool)
    bad[owner[~np.isfinite(flat)]] = True
    good = ~bad & (sizes > 0)
    return np.flatnonzero(good), sizes[good], flat[good[owner]]


def matrices(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of that many entries as a matrix, and their row numbers."""
    rows, sizes, flat = usable(batch)
    same = sizes == width
    return rows[same], flat[np.repeat(same, sizes)].reshape(-1, width)


def keys(batch: pa.RecordBatch, rows: np.ndarray) -> pa.Array:
    return batch.column(batch.schema.get_field_index("key")).take(pa.array(rows))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def list_rows(matrix: np.ndarray) -> pa.ListArray:
    """A matrix as list values, a row each."""
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))
