"""Token ids in patched frame-of-reference blocks.

Documents are dealt out by doc_id range, so files follow in ascending order. A file's rows
are pages of whole documents, of about ``PAGE`` ids; a page holds

* ``docs``, ``counts``: 64-bit ids of its documents and their numbers of ids,
* ``blocks``: blocks of ``BLOCK`` ids (the last may be shorter), one after the other,
* ``index``: the 32-bit byte offset of each block in ``blocks``.

A block is its number of ids, least id, bit width and number of exceptions (little-endian
``<IIBH``), the ids less the least, packed at that width, then the exceptions' places (16 bits)
and values (32 bits). The width fits the given percentile of the block's values; larger
ones are exceptions. Pages are rows of Parquet files, so Spark commits, splits and reads
them on any store.

Nulls and odd rows: a null or empty text is its end id alone; rows without id come last, and
rows of equal id (or none) follow the hash of their texts; repeated rows are written once
each; other columns are ignored; an empty table gives no page. The greatest 64-bit id stands
for none.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindscope.llm import shared
from bindscope.llm.encode import Encoder
from bindscope.llm.tokens import slices

BLOCK, PAGE, PERCENTILE = 1024, 1 << 16, 90
NO_ID = np.iinfo(np.int64).max
HEAD = struct.Struct("<IIBH")
PAGES = "shard long, page long, n_ids long, docs binary, counts binary, index binary, blocks binary"


def encode_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    low = int(ids.min())
    rest = ids.astype(np.int64) - low
    typical = int(np.partition(rest, k := (len(rest) - 1) * percentile // 100)[k])
    width = typical.bit_length()
    odd = np.flatnonzero(rest >> width)
    body = rest.astype("<u2" if width <= 16 else "<u4")
    body[odd] = 0
    bits = np.unpackbits(body.view(np.uint8), bitorder="little").reshape(len(body), -1)[:, :width]
    return b"".join([
        HEAD.pack(len(ids), low, width, len(odd)), np.packbits(bits, bitorder="little").tobytes(),
        odd.astype("<u2").tobytes(), rest[odd].astype("<u4").tobytes(),
    ])


def decode_block(data: bytes, at: int) -> np.ndarray:
    n, low, width, odd = HEAD.unpack_from(data, at)
    at += HEAD.size
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width, bitorder="little")
    whole = np.zeros((n, 16 if width <= 16 else 32), np.uint8)
    whole[:, :width] = bits.reshape(n, width)
    ids = np.packbits(whole, bitorder="little").view("<u2" if width <= 16 else "<u4").astype(np.int64)
    place = np.frombuffer(data, "<u2", odd, at + size)
    ids[place] = np.frombuffer(data, "<u4", odd, at + size + 2 * odd)
    return (ids + low).astype(np.uint32)


def encode_page(ids: np.ndarray) -> tuple[bytes, bytes]:
    blocks = [encode_block(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])[:-1]])
    return starts.astype("<u4").tobytes(), b"".join(blocks)


def decode_page(index: bytes, blocks: bytes) -> np.ndarray:
    return np.concatenate([decode_block(blocks, int(at)) for at in np.frombuffer(index, "<u4")])


def writer(path: str, end: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, page = Encoder.of(path), TaskContext.get().partitionId(), 0
        docs: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def cut() -> pa.RecordBatch:
            index, blocks = encode_page(np.concatenate(held))
            counts = np.array([len(x) for x in held], "<i8").tobytes()
            return pa.record_batch(
                [pa.array([shard]), pa.array([page]), pa.array([size]),
                 *(pa.array([x], pa.binary()) for x in (np.array(docs, "<i8").tobytes(), counts, index, blocks))],
                names=[f.split()[0] for f in PAGES.split(", ")],
            )

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist(), end)):
                    docs.append(NO_ID if doc is None else doc)
                    held.append(ids)
                    size += len(ids)
                    if size >= PAGE:
                        yield cut()
                        docs, held, size, page = [], [], 0, page + 1
        if held:
            yield cut()

    return rows


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int = 2) -> None:
    """Writes the ids of all documents, each followed by ``end``, to pages in ``path``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.asc_nulls_last("doc_id"), F.xxhash64("text").asc()]
    rows = rows.repartitionByRange(shared.partitions(docs.sparkSession), *order).sortWithinPartitions(*order, "text")
    rows.mapInArrow(writer(tokenizer, end), PAGES).write.parquet(path)


def reader(with_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                docs, counts = np.frombuffer(r["docs"], "<i8"), np.frombuffer(r["counts"], "<i8")
                ids = decode_page(r["index"], r["blocks"])
                end = np.cumsum(counts)
                raw = [ids[a:b].astype("<u4").tobytes() for a, b in zip(end - counts, end)]
                columns = [pa.array(docs, mask=docs == NO_ID), pa.array(end - counts + r["before"]), pa.array(counts), pa.array([zlib.crc32(x) for x in raw], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(raw, pa.binary()))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)

    return rows


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, ids (32-bit)."""
    pages = spark.read.schema(PAGES).parquet(path)
    sizes = pages.select("shard", "page", "n_ids")
    # One row a file reaches the numbering of files; pages are numbered file by file.
    files = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("shard").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "page", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inner"))
    starts = starts.join(files, "shard").select("shard", "page", (F.col("inner") + F.col("ahead")).alias("before"))
    whole = pages.join(starts, ["shard", "page"]).select("docs", "counts", "index", "blocks", "before")
    return whole.mapInArrow(reader(with_ids), "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))
