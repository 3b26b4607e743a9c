"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are lower-cased ASCII letters, digits and characters beyond ASCII. Every text keeps,
for each run of ``WINDOW`` words, the least hash of its ``K``-word grams. A shared run of
``WINDOW`` words has the same least hash on both sides, so joining these fingerprints finds
every document that shares one, and few others. Hits are then extended: the windows around
a hit are compared as a whole, through the hashes of their two halves (128 bits). Items
of fewer than ``WINDOW`` words have no full window; they are one window of their own
length, matched directly for the (at most nine) lengths that occur.

The fingerprints of the benchmark are broadcast while their measured number is at most
``BROADCAST_ROWS``; above it, Spark shuffles both sides.

Nulls and odd rows: a null, empty or wordless text has no words and no hits; every row is a
document of its own, also without id or with one that repeats; repeated benchmark rows
count once; items without id are searched, but add no name; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindscope.llm import shared

K, WINDOW = 5, 10
KEY = "__key"
BROADCAST_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """``lower`` and A-Z by table agree on ASCII texts; the first is much faster."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, SEPARATORS), "")


def grams(word: str, n: int) -> Column:
    """Hashes of all runs of ``n`` words of the array column."""
    return F.when(
        F.size(word) >= n,
        F.transform(F.sequence(F.lit(0), F.size(word) - n), lambda i: F.xxhash64(*[F.get(word, i + j) for j in range(n)])),
    ).otherwise(F.array().cast("array<bigint>"))


def least(gram: str) -> Column:
    """The fingerprint of every window, by its first gram."""
    width = WINDOW - K + 1
    return F.when(
        F.size(gram) >= width,
        F.transform(F.sequence(F.lit(1), F.size(gram) - width + 1), lambda i: F.array_min(F.slice(gram, i, width))),
    ).otherwise(F.array().cast("array<bigint>"))


def bounded(df: DataFrame) -> DataFrame:
    """A broadcast hint if the measured number of rows allows it."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def benchmark_windows(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_id, n, a, b): windows of the items; (h): fingerprints of the full ones."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("item_id", words(F.col("text")).alias("w")).filter("size(w) > 0")
    full = rows.filter(F.size("w") >= WINDOW).select("item_id", grams("w", K).alias("g"))
    spread = full.select("item_id", "g", F.explode(F.sequence(F.lit(0), F.size("g") - (WINDOW - K + 1))).alias("i"))
    full_windows = spread.select("item_id", F.lit(WINDOW).alias("n"), F.get("g", F.col("i")).alias("a"), F.get("g", F.col("i") + K).alias("b"))
    short = rows.filter(F.size("w") < WINDOW).select(
        "item_id", F.size("w").alias("n"), F.xxhash64(F.concat_ws(" ", "w")).alias("a"), F.xxhash64(F.concat_ws("  ", "w"), F.size("w")).alias("b")
    )
    windows = shared.cut_lineage(full_windows.unionByName(short).distinct())
    prints = full.select(F.explode(least("g")).alias("h")).distinct()
    return windows, prints


def short_hits(docs: DataFrame, windows: DataFrame) -> DataFrame | None:
    """(doc_id, start, n, a, b) of short windows in the documents. Lengths: nine at most."""
    lengths = sorted(r.n for r in windows.filter(F.col("n") < WINDOW).select("n").distinct().collect())
    out = None
    text = docs.select("doc_id", words(F.col("text")).alias("w"))
    for n in lengths:
        wanted = bounded(windows.filter(F.col("n") == n).select("a", "b").distinct())
        run = F.transform(
            F.sequence(F.lit(1), F.size("w") - n + 1),
            lambda i: F.struct(
                i.alias("start"), F.xxhash64(F.concat_ws(" ", F.slice("w", i, n))).alias("a"),
                F.xxhash64(F.concat_ws("  ", F.slice("w", i, n)), F.lit(n)).alias("b"),
            ),
        )
        found = text.filter(F.size("w") >= n).select("doc_id", F.inline(run)).join(wanted, ["a", "b"]).select(
            "doc_id", "start", F.lit(n).alias("n"), "a", "b"
        )
        out = found if out is None else out.unionByName(found)
    return out


def scanned(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """doc_id, n_words, and the windows (start, a, b) whose fingerprint is in ``prints``."""
    hits = (
        docs.select("doc_id", words(F.col("text")).alias("w")).select("doc_id", grams("w", K).alias("g"))
        .select("doc_id", F.explode(F.array_distinct(least("g"))).alias("h")).join(bounded(prints), "h")
    )
    per_doc = hits.groupBy("doc_id").agg(F.collect_set("h").alias("hit"))
    read = docs.join(per_doc, "doc_id", "left").select("doc_id", "hit", words(F.col("text")).alias("w"))
    read = read.select("doc_id", "hit", F.size("w").cast("long").alias("n_words"), F.when(F.col("hit").isNotNull(), grams("w", K)).alias("g"))
    read = read.select("doc_id", "hit", "n_words", "g", F.when(F.col("g").isNotNull(), least("g")).alias("m"))
    near = F.filter(F.sequence(F.lit(1), F.size("m")), lambda i: F.array_contains("hit", F.get("m", i - 1)))
    window = F.transform(near, lambda i: F.struct(i.alias("start"), F.get("g", i - 1).alias("a"), F.get("g", i - 1 + K).alias("b")))
    return read.select("doc_id", "n_words", F.when(F.size("m") > 0, window).alias("windows"))


def matched(rows: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_words) of all keyed rows, doc_id being the key; per hit row its window
    places ``spans`` (start from 1, n) and the ids of the items found, as strings."""
    docs = rows.select(F.col(KEY).alias("doc_id"), F.col("text").cast("string").alias("text"))
    windows, prints = benchmark_windows(items)
    read = shared.cut_lineage(scanned(docs, prints))
    known = windows.select("n", "a", "b").distinct()
    full = read.filter(F.size("windows") > 0).select("doc_id", F.inline("windows"))
    full = full.join(bounded(known.filter(F.col("n") == WINDOW)), ["a", "b"]).select("doc_id", "start", "n", "a", "b")
    short = short_hits(docs, windows)
    found = shared.cut_lineage(full if short is None else full.unionByName(short))
    places = found.groupBy("doc_id").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    named = (
        found.select("doc_id", "n", "a", "b").distinct().join(bounded(windows), ["n", "a", "b"])
        .groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return read.select("doc_id", "n_words"), places.join(named, "doc_id")


def covered(spans: Column) -> Column:
    """Words under any of the (start, n) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))

    def add(acc: Column, s: Column) -> Column:
        end = s["start"] + s["n"]
        fresh = F.greatest(end - F.greatest(s["start"], acc["end"]), F.lit(0))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["total"] + fresh).alias("total"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda acc: acc["total"])


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items (array)."""
    rows = shared.keyed(docs, KEY)
    everyone, hit = matched(rows, items)
    out = everyone.join(hit, "doc_id", "left").withColumnRenamed("doc_id", KEY)
    out = out.join(rows.select(KEY, F.col("doc_id").cast("long").alias("doc_id")), KEY)
    names = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), names.alias("items"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share no window with an item."""
    rows = shared.keyed(docs, KEY)
    _, hit = matched(rows, items)
    return rows.join(hit.select(F.col("doc_id").alias(KEY)), KEY, "left_anti").select(docs.columns)
