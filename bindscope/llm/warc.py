"""WARC archives: writing, and reading by boundary-chain verification.

Writing: one record a page. Of the records with equal payloads of at least ``min_bytes``
bytes, that with the largest page_id is a response, the others are revisits of it, without
payload. Spark writes the archives as text files whose line separator is the end of a
record, so tasks are committed and repeated as usual.

Reading: splits of the archives are cut at the magic ``WARC/1.1``; each piece is a candidate
record, whose length header gives its successor's offset. A magic inside a payload makes
false candidates; a piece whose header can't be read as one, or whose length is not one to
eighteen decimal digits, is none. Within a split, tasks link each candidate to the place where its chain
leaves the split; across splits, pointer jumping from offset 0 finds the places that the
true chain enters. Candidates on the chain are the records. A record of several pieces is put
together in a second pass, which runs only if there is one.

Nulls and odd rows: null html is an empty payload, a null url writes no target, line breaks in
a url are escaped; a row without page_id is a record whose id is read back as null, and revisits
the page of equal payload with the largest id if there is one; repeated rows are one record
each, and of equal ids with equal payload none revisits itself; other columns are ignored; an
empty table gives empty results. An id that is no 64-bit integer is read as null.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindscope.llm import shared
from bindscope.llm.tokens import text_bytes

#: Fixed values of the format; the block of a response is a HTTP response.
MAGIC, LINE = "WARC/1.1\r\n", "\r\n"
STATUS = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A length, and the number in a page's id.
LENGTH, PAGE = re.compile(r"[0-9]{1,18}", re.ASCII), re.compile(r"-?[0-9]{1,19}", re.ASCII)
#: Bits of the filter that tells pages whose digest may repeat: one megabyte at any size.
FILTER_BITS = 1 << 23
DIGITS_32, BASE_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PIECE = (
    "file string, block long, at long, size long, next long, complete boolean, page_id long, payload_bytes long, "
    "payload_digest string, record_type string, refers_to long, url string, payload binary, raw binary"
)
NAMES = [f.split()[0] for f in PIECE.split(", ")]


def digest_32(sha1_hex: Column) -> Column:
    """Base 32 of a SHA-1 in hexadecimal, five bytes at a time."""
    parts = [F.lpad(F.conv(F.substring(sha1_hex, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), DIGITS_32, BASE_32)


def records(pages: DataFrame, min_bytes: int, date: str) -> DataFrame:
    """One record a row, without the two line ends that close it."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", digest_32(F.sha1(F.col("html").cast("binary"))))
    rows = rows.withColumn("bytes", F.octet_length("html"))
    first = (
        rows.filter(F.col("bytes") >= min_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "kept")
    )
    # Only pages whose digest may repeat meet the table of repeats; all others stay where they are.
    bit = F.pmod(F.xxhash64("digest"), F.lit(FILTER_BITS))
    word = (bit / 64).cast("int")
    set_bits = first.groupBy(word.alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))).alias("bits"))
    words = pages.sparkSession.range(FILTER_BITS // 64).select(F.col("id").cast("int").alias("w")).join(set_bits, "w", "left")
    seen = words.agg(F.array_sort(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("s"))
    marks = seen.select(F.transform("s", lambda x: x["bits"])).scalar()
    maybe = F.getbit(F.get(marks, word), (bit % 64).cast("int")) == 1
    alone = rows.filter(~maybe).withColumn("kept", F.lit(None).cast("long"))
    rows = rows.filter(maybe).join(first, "digest", "left").select(alone.columns).unionAll(alone)
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(LINE))
    head = F.concat(F.lit(STATUS), F.col("bytes").cast("string"), F.lit(LINE + LINE))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("html")))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    return rows.select(F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", page("page_id")), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", page("kept")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(LINE), block,
    ).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    records(pages, min_bytes, date).write.option("lineSep", LINE + LINE).text(path)


def parse(raw: bytes) -> tuple[int, dict[str, str]] | None:
    """Length of the header and its fields, if ``raw`` (what follows a magic) begins with one."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for entry in raw[:end].split(b"\r\n"):
        name, colon, value = entry.partition(b":")
        if not colon:
            return None
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return (end + 4, fields) if LENGTH.fullmatch(fields.get("content-length", "")) and fields.get("warc-type") else None


def number(text: str | None) -> int | None:
    tail = (text or "").removeprefix("<urn:page:").removesuffix(">")
    value = int(tail) if PAGE.fullmatch(tail) else None
    return value if value is not None and -(2**63) <= value < 2**63 else None


def content(raw: bytes) -> tuple:
    """page_id, payload bytes, digest, type, revisited page, url and payload of a whole record;
    nulls where ``raw`` doesn't hold them."""
    parsed = parse(raw)
    if parsed is None:
        return (None,) * 7
    start, fields = parsed
    block = raw[start : start + int(fields["content-length"])]
    kind = fields["warc-type"]
    head, _, payload = block.partition(b"\r\n\r\n")
    if kind == "response":
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    else:
        length = [x.split(b":", 1)[1].strip().decode("utf-8", "replace") for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        size = int(length[0]) if length and LENGTH.fullmatch(length[0]) else 0
        digest, payload = fields.get("warc-payload-digest", "").removeprefix("sha1:"), None
    return number(fields.get("warc-record-id")), size, digest, kind, number(fields.get("warc-refers-to")), fields.get("warc-target-uri"), payload


def scan(keep_raw: bool, keep_payload: bool):
    """Pieces of each split, in order: place (within the split) of the magic before the
    piece, size with the magic, successor's place; fields of complete records."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at = None, 0
        for batch in batches:
            data, offset = text_bytes(batch.column(0))
            files, blocks = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out = []
            for i in range(batch.num_rows):
                if (files[i], blocks[i]) != here:
                    here, at = (files[i], blocks[i]), -len(MAGIC) if blocks[i] == 0 else 0
                raw = data[offset[i] : offset[i + 1]].tobytes()
                size = len(raw) + len(MAGIC)
                found, row = parse(raw), (None, False, *[None] * 7)
                if found:
                    whole = found[0] + int(found[1]["content-length"])
                    complete = len(raw) >= whole
                    row = (at + len(MAGIC) + whole + 4, complete, *(content(raw) if complete else (None,) * 7))
                    if not keep_payload:
                        row = (*row[:-1], None)
                out.append((*here, at, size, *row, raw if keep_raw else None))
                at += size
            yield table(out)

    return rows


def table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    types = [kinds[f.split()[1]] for f in PIECE.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=NAMES)


def pieces(spark: SparkSession, path: str, keep_raw: bool, keep_payload: bool = False) -> DataFrame:
    lines = spark.read.option("lineSep", MAGIC).text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return lines.mapInArrow(scan(keep_raw, keep_payload), PIECE)


def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each candidate of a split, the place where its chain leaves the split (null: the
    chain breaks off)."""
    for _, part in shared.grouped_rows(batches, "split"):
        order = np.argsort(part.column("at").to_numpy(), kind="stable")
        part = part.take(pa.array(order))
        at, following = part.column("at").to_numpy(), part.column("next").to_pylist()
        end = int(at[-1]) + part.column("size")[-1].as_py()
        leaves: dict[int, int | None] = {}
        for a, n in zip(at[::-1].tolist(), following[::-1]):
            leaves[a] = None if n is None else n if n >= end else leaves.get(n)
        yield pa.record_batch(
            [part.column("file").combine_chunks(), pa.array(at), pa.array([leaves[a] for a in at.tolist()], pa.int64())], names=["file", "at", "leaves"]
        )


def on_chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of a split that the chain passes, from the place ``entry``."""
    for _, part in shared.grouped_rows(batches, "split"):
        entries = {x for x in part.column("entry").to_pylist() if x is not None}
        following = dict(zip(part.column("at").to_pylist(), part.column("next").to_pylist()))
        passed = []
        for place in entries:
            while place in following:
                passed.append(place)
                if following[place] is None or following[place] <= place:
                    break
                place = following[place]
        if passed:
            yield pa.record_batch([pa.array([part.column("file")[0].as_py()] * len(passed)), pa.array(passed, pa.int64())], names=["file", "at"])


def verified(found: DataFrame) -> DataFrame:
    """(file, at): candidates reachable from the start of their file. ``found``: stored
    pieces with places within the file."""
    spark = found.sparkSession
    n = shared.partitions(spark)
    split = F.xxhash64("file", "block").alias("split")
    dealt = found.select(split, "file", "at", "size", "next").repartition(n, "split").sortWithinPartitions("split")
    jumps = shared.cut_lineage(dealt.mapInArrow(exits, "file string, at long, leaves long").filter("leaves is not null"))
    start = found.select("file").distinct().withColumn("at", F.lit(0).cast("long"))
    reached = shared.cut_lineage(start)
    size = reached.count()
    # Only places that some chain enters matter across splits; each round doubles the jump.
    entered = jumps.select("file", F.col("leaves").alias("at")).unionByName(start).distinct()
    hop = shared.cut_lineage(jumps.join(entered, ["file", "at"], "left_semi"))
    while True:
        more = reached.join(hop, ["file", "at"]).select("file", F.col("leaves").alias("at"))
        reached = shared.cut_lineage(reached.unionByName(more).distinct())
        now = reached.count()
        if now == size:
            break
        size = now
        nearer = hop.select("file", F.col("at").alias("from"), F.col("leaves").alias("at"))
        hop = shared.cut_lineage(nearer.join(hop, ["file", "at"]).select("file", F.col("from").alias("at"), "leaves"))
    entry = reached.withColumn("entry", F.col("at"))
    marked = found.select(split, "file", "at", "next").join(entry, ["file", "at"], "left").select("split", "file", "at", "next", "entry")
    return marked.repartition(n, "split").sortWithinPartitions("split").mapInArrow(on_chain, "file string, at long").distinct()


def placed(found: DataFrame) -> DataFrame:
    """Pieces with places within their file; a file's splits are few."""
    ahead = found.groupBy("file", "block").agg(F.sum("size").alias("bytes"), F.min("at").alias("low"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ahead.select("file", "block", F.coalesce(F.sum(F.col("bytes") + F.col("low")).over(before), F.lit(0)).alias("ahead"))
    out = found.join(ahead, ["file", "block"]).withColumn("at", F.col("at") + F.col("ahead")).withColumn("next", F.col("next") + F.col("ahead"))
    return out.drop("ahead")


def put_together(rows: pa.Table) -> pa.Table:
    """The pieces of one record, in order."""
    rows = rows.sort_by("at")
    raw = MAGIC.encode().join(rows.column("raw").to_pylist())
    page, size, digest, kind, refers, url, payload = content(raw)
    return pa.table({
        "page_id": pa.array([page], pa.int64()), "payload_bytes": pa.array([size], pa.int64()), "payload_digest": pa.array([digest], pa.string()),
        "record_type": pa.array([kind], pa.string()), "refers_to": pa.array([refers], pa.int64()), "url": pa.array([url], pa.string()),
        "file": rows.column("file").slice(0, 1), "offset": rows.column("record").slice(0, 1), "payload": pa.array([payload], pa.binary()),
    })


RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string, offset long, payload binary"


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url, file, offset (of the
    record in its file) and, with ``payload``, the payload of each record; a revisit has none."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file", F.col("at").alias("offset"), "payload"]
    found = placed(shared.cut_lineage(pieces(spark, path, False, payload).drop("raw")))
    narrow = found.select("file", "block", "at", "size", "next", "complete")
    marked = shared.cut_lineage(narrow.join(verified(narrow), ["file", "at"]).select("file", "at", "complete"))
    whole = found.join(marked.filter("complete").select("file", "at"), ["file", "at"]).select(columns)
    if marked.filter("not complete").isEmpty():
        return whole if payload else whole.drop("payload")
    # Pieces after a record's first belong to it up to the next record's place.
    starts = marked.select("file", "at", F.col("at").alias("record"), (~F.col("complete")).alias("open"))
    order = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owner = narrow.select("file", "at").join(starts, ["file", "at"], "left").select(
        "file", "at", F.last("record", ignorenulls=True).over(order).alias("record"), F.last("open", ignorenulls=True).over(order).alias("open")
    ).filter("open")
    text = placed(pieces(spark, path, True)).select("file", "at", "raw").join(owner, ["file", "at"])
    broken = text.select("file", "record", "at", "raw").groupBy("file", "record").applyInArrow(put_together, RESULT)
    return whole.unionByName(broken) if payload else whole.unionByName(broken).drop("payload")
