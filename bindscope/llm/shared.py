"""Shared helpers of the operators: tables, lineage cuts, packed exchanges, components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindscope.session import cut_lineage, scratch

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_id(docs: DataFrame, ids: DataFrame, how: str = "left", key: str = "doc_id") -> DataFrame:
    return docs.join(ids, key, how)


def keyed(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with a column ``key`` of its own for each row: doc_id where all rows have
    one and none repeats; else a number, stored with the rows so that it stays the same."""
    own = docs.withColumn(key, F.col("doc_id").cast("long"))
    odd = own.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col(key).isNull() | (F.col("n") > 1))
    if odd.isEmpty():
        return own
    path = scratch(docs.sparkSession, "keyed")
    docs.withColumn(key, F.monotonically_increasing_id()).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def buckets(spark: SparkSession) -> int:
    """Buckets of a packed exchange: one for each shuffle partition, so that packed rows
    number tasks times partitions at most."""
    return partitions(spark)


def split_by_bucket(bucket: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that groups entries by bucket, and the bounds of each bucket in it."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(count + 1))


def exchange(blobs: DataFrame) -> DataFrame:
    """Deals each bucket's packed rows to a partition of its own."""
    return blobs.repartitionById(buckets(blobs.sparkSession), F.col("bucket")).sortWithinPartitions("bucket")


def grouped_rows(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """Runs of equal ``key`` over batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    current: int | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and values[a] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = values[a]
            held.append(batch.slice(int(a), int(b - a)))
    if held:
        yield current, pa.Table.from_batches(held)


def joined(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """Packed values of all rows of a binary column, in order."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of (a, b) links: (node, component), component being the
    smallest node reachable. Nodes without links don't appear.

    Alternates two star contractions until nothing changes; rounds grow with the
    logarithm of the longest path. A star's centre is met in joins only, which Spark can
    split, and minima are combined before each shuffle.
    """
    def digest(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e = cut_lineage(e)
    seen = digest(e)
    while seen[0]:
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        e = cut_lineage(small.filter("u <> v").distinct())
        now = digest(e)
        if now == seen:
            break
        seen = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def trim_words(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def arrow_schema(fields: Sequence[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema(list(fields))
