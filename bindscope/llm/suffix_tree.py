"""Language-model scoring with a probabilistic suffix tree.

Texts are lower-cased (A-Z) and read as words, each followed by a separator, then an end. Over
the symbols of this stream (``SYMBOL``: bytes, rare ones in classes within which they are
equally likely), the tree keeps contexts of up to ``DEPTH`` symbols. A context is
considered if its share of all training symbols is at least ``min_share`` (so there are at
most DEPTH / min_share, whatever the corpus) and retained if its next-symbol distribution
diverges from that of the context one shorter: n * KL > ``PENALTY`` * u * ln n, with n
occurrences and u next symbols. Distributions are smoothed towards the shorter context's
(Witten-Bell). A symbol is scored in the state of its longest suffix in the tree. A word's chance
is that of its symbols, mixed evenly with the base model's (below). Counts cover all training
texts: tasks add up their own n-grams, these meet packed, by context.

The base score is a unigram model over words and end, add-one. The ``top`` most frequent words
are looked up in the pass over the texts; all others meet their counts by a join.

Training: crc32(doc_id as text) mod 7 is not 2. Nulls and odd rows: a null or empty text is its
end alone; a row without id trains, is not held out and returns a row of its own; repeated rows count as often as they occur and
each return a row; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindscope.llm import shared
from bindscope.llm.tokens import U, Words, mix, mix1, packed, ranges, slices
from bindscope.session import scratch

DEPTH, SIZE, BITS = 5, 64, 6
#: Bytes of text read at a time: a symbol takes about 80 bytes while it is counted or scored.
SLICE = 1 << 20
END, SEPARATOR = 0, 1
WORD = DEPTH + 1  # the kind of word counts; kinds 0 to DEPTH are the orders of contexts
END_HASH = np.uint64(mix1(0xE0D))
MERGE = 2_000_000
PENALTY = 0.25
UNIGRAM = 0.5
BLOBS = "bucket int, kind int, keys binary, counts binary"
COUNTS = "kind int, key long, n long, next binary"


def symbols() -> tuple[np.ndarray, np.ndarray]:
    """The symbol of each byte, and log10 of the byte's share within its symbol."""
    symbol = np.full(256, 63, np.int64)
    groups = [[c] for c in range(ord("a"), ord("z") + 1)] + [list(range(ord("0"), ord("9") + 1))]
    groups += [[c] for c in b".,;:'\"-!?()|"]
    groups += [[c] for c in (0xC3, 0x9F, 0xA0, 0xA1, 0xA4, 0xA7, 0xA8, 0xA9, 0xAA, 0xAD, 0xB1, 0xB3, 0xB4, 0xB6, 0xBA, 0xBC)]
    named = {c for g in groups for c in g}
    groups += [[c for c in range(0x21, 0x7F) if c not in named], [c for c in range(0x80, 0xC0) if c not in named]]
    for number, group in enumerate(groups, start=2):
        symbol[group] = number
    share = -np.log10(np.bincount(symbol, minlength=SIZE)[symbol])
    return symbol, share


SYMBOL, SHARE = symbols()


class Stream:
    """Symbols of a batch: ``codes`` are at places ``at`` (those that count), of rows ``row``."""

    def __init__(self, words: Words):
        length = words.end - words.start
        per_row = np.bincount(words.row, length + 1, minlength=words.rows).astype(np.int64) + DEPTH
        first = DEPTH + np.cumsum(per_row) - per_row
        inner = np.cumsum(length + 1) - (length + 1)
        before = inner[np.minimum(words.first[:-1], max(0, len(inner) - 1))] if len(inner) else np.zeros(words.rows, np.int64)
        self.start = first[words.row] + inner - before[words.row]
        start = self.start
        self.stop = start + length + 1
        self.symbols = np.full(DEPTH + int(per_row.sum()), SEPARATOR, np.int64)
        self.share = np.zeros(len(self.symbols))
        self.symbols[:DEPTH] = END
        source, target = words.data[ranges(words.start, length)], ranges(start, length)
        self.symbols[target] = SYMBOL[source]
        self.share[target] = SHARE[source]
        self.end = end = first + per_row - DEPTH
        self.symbols[(end[:, None] + np.arange(DEPTH)).ravel()] = END
        self.at = ranges(first, per_row - DEPTH + 1)
        self.row = np.repeat(np.arange(words.rows), per_row - DEPTH + 1)

    def codes(self, take: np.ndarray) -> np.ndarray:
        at = self.at[take]
        code = self.symbols[at].copy()
        for k in range(1, DEPTH + 1):
            code |= self.symbols[at - k] << (BITS * k)
        return code


class Tally:
    """Counts by key; parts are merged as they grow."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        self.parts.append(summed(keys, counts))
        self.size += len(self.parts[-1][0])
        if self.size > MERGE and len(self.parts) > 4:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.parts = [summed(*(np.concatenate(x) for x in zip(*self.parts)))]
        self.size = 0
        return self.parts[0]


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    keys = keys.astype(np.uint64)
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[start], np.add.reduceat(counts, start) if len(keys) else counts


def trains(ids: pa.Array) -> np.ndarray:
    return np.array([i is None or zlib.crc32(b"%d" % i) % 7 != 2 for i in ids.to_pylist()], bool)


def count(buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, unigrams = Tally(), Tally()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                use = trains(part.column(0))
                part = part.filter(pa.array(use))
                if not part.num_rows:
                    continue
                words = Words(part.column(1), lower=True)
                unigrams.add(np.append(words.hashes(), np.full(words.rows, END_HASH)))
                stream = Stream(words)
                grams.add(stream.codes(np.arange(len(stream.at))))
        keys, counts = unigrams.total()
        tallies = [(WORD, keys, counts)]
        keys, counts = grams.total()
        for order in range(DEPTH, -1, -1):
            if order < DEPTH:
                keys, counts = summed(keys & U((1 << BITS * (order + 1)) - 1), counts)
            tallies.append((order, keys, counts))
        for kind, keys, counts in tallies:
            context = keys if kind == WORD else keys >> U(BITS)
            order, at = shared.split_by_bucket((mix(context + U(kind)) % U(buckets)).astype(np.int64), buckets)
            full = np.flatnonzero(np.diff(at))
            if len(full):
                yield pa.record_batch(
                    [pa.array(full, pa.int32()), pa.array(np.full(len(full), kind), pa.int32()),
                     pa.array([packed(keys[order[at[b] : at[b + 1]]]) for b in full], pa.binary()),
                     pa.array([packed(counts[order[at[b] : at[b + 1]]].astype(np.int64)) for b in full], pa.binary())],
                    names=["bucket", "kind", "keys", "counts"],
                )

    return rows


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: counts of words; contexts with their next symbols' counts."""
    for _, part in shared.grouped_rows(batches, "bucket"):
        kinds = part.column("kind").to_numpy()
        for kind in np.unique(kinds):
            some = part.filter(pa.array(kinds == kind))
            keys, counts = summed(shared.joined(some.column("keys"), np.uint64), shared.joined(some.column("counts"), np.int64))
            after: list[bytes | None] = [None] * len(keys)
            if kind != WORD:
                context = keys >> U(BITS)
                start = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
                edge = np.append(start, len(keys))
                pair = np.stack([(keys & U(SIZE - 1)).astype(np.int64), counts], axis=1)
                after = [packed(pair[a:b]) for a, b in zip(edge[:-1], edge[1:])]
                keys, counts = context[start], np.add.reduceat(counts, start)
            for a in range(0, len(keys), 50_000):
                k = keys[a : a + 50_000].view(np.int64)
                yield pa.record_batch(
                    [pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(counts[a : a + 50_000], pa.int64()), pa.array(after[a : a + 50_000], pa.binary())],
                    names=["kind", "key", "n", "next"],
                )


@dataclass
class Tree:
    """``child[node, symbol]``: the node one symbol further back, or -1. ``chance[node,
    symbol]``: log10 of the next symbol's chance."""

    child: np.ndarray
    chance: np.ndarray

    def tokens(self, words: Words) -> np.ndarray:
        """log10 of the chance of each word with its separator, then of each row's end."""
        stream = Stream(words)
        node = np.zeros(len(stream.at), np.int64)
        walking = np.arange(len(node))
        for k in range(1, DEPTH + 1):
            further = self.child[node[walking] * SIZE + stream.symbols[stream.at[walking] - k]]
            on = further >= 0
            walking = walking[on]
            node[walking] = further[on]
        value = self.chance[node * SIZE + stream.symbols[stream.at]] + stream.share[stream.at]
        total = np.zeros(len(stream.symbols) + 1)
        total[stream.at + 1] = value
        ends = total[stream.end + 1].copy()
        np.cumsum(total, out=total)
        return np.append(total[stream.stop] - total[stream.start], ends)

    def score(self, words: Words) -> np.ndarray:
        return np.bincount(np.append(words.row, np.arange(words.rows)), self.tokens(words), minlength=words.rows)


def grow(levels: list[tuple[np.ndarray, np.ndarray, list[bytes]]]) -> Tree:
    """The tree from each order's contexts: keys, occurrences, next counts."""
    uniform = np.full(SIZE, 1 / SIZE)
    smooth: list[np.ndarray] = []
    kept: list[np.ndarray] = []
    keys: list[np.ndarray] = []
    parents: list[np.ndarray] = []
    for order, (key, n, after) in enumerate(levels):
        by = np.argsort(key)
        key, n = key[by], n[by]
        counts = np.zeros((len(key), SIZE))
        for i, raw in enumerate(after[j] for j in by):
            pair = np.frombuffer(raw, np.int64).reshape(-1, 2)
            counts[i, pair[:, 0]] = pair[:, 1]
        parent = np.searchsorted(keys[-1], key & ((1 << BITS * (order - 1)) - 1)) if order else np.zeros(len(key), int)
        base = smooth[-1][parent] if order else np.tile(uniform, (len(key), 1))
        kinds = (counts > 0).sum(axis=1, keepdims=True)
        p = (counts + kinds * base) / np.maximum(counts.sum(axis=1, keepdims=True) + kinds, 1)
        gain = n * (p * np.log(p / base)).sum(axis=1)
        kept.append((gain > PENALTY * kinds[:, 0] * np.log(np.maximum(n, 2))) | (order == 0))
        keys.append(key)
        parents.append(parent)
        smooth.append(p)
    if not len(keys[0]):
        return Tree(np.full(SIZE, -1, np.int32), np.log10(uniform).astype(np.float32))
    needed = [k.copy() for k in kept]
    for order in range(len(levels) - 1, 0, -1):
        needed[order - 1][parents[order][needed[order]]] = True
    number = [np.cumsum(x) - 1 for x in needed]
    ahead = np.concatenate([[0], np.cumsum([int(x.sum()) for x in needed])])
    nodes = int(ahead[-1])
    child = np.full((nodes, SIZE), -1, np.int32)
    chance = np.zeros((nodes, SIZE), np.float32)
    for order in range(len(levels)):
        take = np.flatnonzero(needed[order])
        own = ahead[order] + number[order][take]
        if order == 0:
            chance[own] = np.log10(smooth[0][take])
            continue
        up = ahead[order - 1] + number[order - 1][parents[order][take]]
        chance[own] = np.where(kept[order][take][:, None], np.log10(smooth[order][take]), chance[up])
        child[up, keys[order][take] >> (BITS * (order - 1))] = own
    return Tree(child.ravel(), chance.ravel())


def mixed(spelled: np.ndarray, share: np.ndarray) -> np.ndarray:
    """log10 of the mean chance."""
    top = np.maximum(spelled, share)
    return top + np.log10(UNIGRAM * 10 ** (share - top) + (1 - UNIGRAM) * 10 ** (spelled - top))


def scorer(tree, frequent, total: int, distinct: int):
    """tree, frequent: broadcasts; frequent: sorted hashes and their counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = frequent.value
        low = math.log10(total + distinct + 1)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = Words(part.column(1), lower=True)
                key = np.append(words.hashes(), np.full(words.rows, END_HASH))
                row = np.append(words.row, np.arange(words.rows))
                at = np.minimum(np.searchsorted(hashes, key), max(0, len(hashes) - 1))
                hit = hashes[at] == key if len(hashes) else np.zeros(len(key), bool)
                value = np.zeros(len(key))
                value[hit] = np.log10(counts[at[hit]] + 1.0) - low
                base = np.bincount(row, value, minlength=words.rows)
                known = np.bincount(row[hit], minlength=words.rows)
                spelled = tree.value.tokens(words)
                score = np.bincount(row[hit], mixed(spelled[hit], value[hit]), minlength=words.rows)
                own = number + np.arange(words.rows)
                number += words.rows
                nothing = pa.nulls(words.rows, pa.int64())
                yield output(own, part.column(0), pa.array(words.count + 1), pa.array(known), pa.array(base), pa.array(score), nothing)
                rare = np.flatnonzero(~hit)
                if len(rare):
                    none, blank = pa.nulls(len(rare), pa.int64()), pa.nulls(len(rare), pa.float64())
                    yield output(own[row[rare]], none, none, none, blank, pa.array(spelled[rare]), pa.array(key[rare].view(np.int64)))

    return rows


SCORED = "row long, doc_id long, n_tokens long, n_known long, base double, score double, word long"


def output(row, *columns) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
    return pa.record_batch([pa.array(row, pa.int64()), *(c.cast(t) for c, t in zip(columns, types))], names=[f.split()[0] for f in SCORED.split(", ")])


def suffix_tree_scores(docs: DataFrame, min_share: float = 2e-5, top: int = 1 << 19) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = scratch(spark, "suffix-counts")
    buckets = shared.buckets(spark)
    shared.exchange(rows.mapInArrow(count(buckets), BLOBS)).mapInArrow(gather, COUNTS).write.parquet(path)
    counts = spark.read.parquet(path)
    words = counts.filter(F.col("kind") == WORD).select(F.col("key").alias("word"), F.col("n").alias("c"))
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # Bounded: ``top`` words, and DEPTH / min_share contexts.
    best = words.orderBy(F.desc("c"), "word").limit(top).toArrow()
    hashes = best.column("word").to_numpy().view(np.uint64)
    by = np.argsort(hashes)
    frequent = spark.sparkContext.broadcast((hashes[by], best.column("c").to_numpy()[by]))
    contexts = counts.filter(F.col("kind") < WORD)
    stream = contexts.filter("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    enough = contexts.filter(F.col("n") >= max(1.0, min_share * stream)).toArrow()
    kinds = enough.column("kind").to_numpy()
    levels = []
    for order in range(DEPTH + 1):
        some = enough.filter(pa.array(kinds == order))
        levels.append((some.column("key").to_numpy(), some.column("n").to_numpy(), some.column("next").to_pylist()))
    tree = spark.sparkContext.broadcast(grow(levels))
    scored_path = scratch(spark, "suffix-scores")
    rows.mapInArrow(scorer(tree, frequent, int(total), int(distinct)), SCORED).write.parquet(scored_path)
    scored = spark.read.schema(SCORED).parquet(scored_path)
    rare = scored.filter("word is not null").select("row", "word", F.col("score").alias("spelled"))
    share = F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(total + distinct + 1)))
    top_one = F.greatest("spelled", "share")
    mean = UNIGRAM * F.pow(F.lit(10.0), F.col("share") - top_one) + (1 - UNIGRAM) * F.pow(F.lit(10.0), F.col("spelled") - top_one)
    met = rare.join(words, "word", "left").select("row", "spelled", "c", share.alias("share")).groupBy("row").agg(
        F.sum("share").alias("more"), F.count("c").alias("more_known"), F.sum(top_one + F.log10(mean)).alias("more_score"),
    )
    whole = scored.filter("word is null").join(met, "row", "left")
    return whole.select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
