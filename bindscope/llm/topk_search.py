"""Exact top-k inner products over vectors sorted by length.

Entries become integers; the sums of products of all rows give, by SVD, a rotation after
which the first coordinates carry most of a vector's length. Candidates are dealt by
falling length and packed into blocks, queries into blocks of even size. A candidate block
goes to a query block only if the longest candidate can reach a score that the longest
``LEAD`` candidates don't beat already. There, blocks run by falling length: a pair lives
while |q||c| (then the partial sum of the first rotated coordinates plus the product of
the lengths of the rest: Cauchy-Schwarz) can reach the query's k-th score. What lives is
scored in exact integers.

Bounds carry a margin for rounding, so nothing that ties or wins is lost, whatever the
data; only the number of pairs scored depends on it.

Odd input: rows whose vector is null, empty, or holds null or non-finite entries take no
part. Vectors of the width most rows have (the larger on a tie) take part; others don't. A
null id is never a query; as a candidate it comes after all ids on a tie. A query is a row:
rows that repeat a query's id give that id's answer once each. A candidate is a query's own
if its id is equal, so repeated rows never answer themselves, but each counts as a
candidate of other queries. Entries are held to +-2^53, a score to the range of 64 bits;
the greatest 64-bit id stands for null. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bindscope.llm.shared import partitions
from bindscope.llm.vectors import doubles, keys, matrices, pieces, usable
from bindscope.session import cut_lineage

SCALE = 256
#: Rows of a candidate block, of a query block, and of one step inside a task.
BLOCK, QUERIES, STEP = 4096, 4096, 1024
#: Longest candidates whose scores start the queries' bounds.
LEAD = 256
MARGIN = 1e-9
LONG = 2**63 - 1
#: Stands for a null id, after all others on a tie.
NO_ID = np.iinfo(np.int64).max
#: Bytes an entry and type: the narrowest that holds the entries is stored.
KINDS = {2: np.int16, 4: np.int32, 8: np.float64}


def integers(matrix: np.ndarray) -> np.ndarray:
    """Integral doubles."""
    return np.clip(np.floor(SCALE * matrix), -(2.0**53), 2.0**53)


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact row-wise products of integral rows, held to 64 bits."""
    most = float(np.abs(a).max(initial=0.0)) * float(np.abs(b).max(initial=0.0)) * a.shape[1]
    if most < 2.0**53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    exact = [sum(int(u) * int(v) for u, v in zip(x, y)) for x, y in zip(a, b)]
    return np.array([min(max(s, -LONG - 1), LONG) for s in exact], np.int64)


def gram(df: DataFrame) -> DataFrame:
    """(width, i, n, row): rows of that width, and row i of the sum of their outer products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in pieces(batches):
            for width in np.unique(usable(batch)[1]).tolist():
                x = integers(matrices(batch, width)[1])
                one = held.setdefault(width, [0, np.zeros((width, width))])
                one[0] += len(x)
                one[1] += x.T @ x
        for width, (n, total) in held.items():
            i, j = np.indices((width, width)).reshape(2, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(width * width, width), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array(np.full(width * width, n), pa.int64()), pa.array(total.ravel())],
                ["width", "i", "j", "n", "v"],
            )

    cells = df.mapInArrow(run, "width int, i int, j int, n long, v double")
    return cells.groupBy("width", "i", "j").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))


def rotation(df: DataFrame) -> np.ndarray | None:
    """Orthonormal columns by falling singular value, d x d; None without vectors."""
    cells = cut_lineage(gram(df))
    top = cells.filter("i = 0 and j = 0").orderBy(F.desc("n"), F.desc("width")).first()
    if top is None:
        return None
    total = np.zeros((top.width, top.width))
    for r in cells.filter(F.col("width") == top.width).toLocalIterator():  # width * width numbers
        total[r.i, r.j] = r.v
    return np.linalg.svd((total + total.T) / 2.0)[0]


class Best:
    """The k best (score, candidate id) of each query of a block, by falling score, then id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.floor = np.full(queries, -np.inf)
        self.last = np.full(queries, NO_ID)

    def wins(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return (score > self.floor[query]) | ((score == self.floor[query]) & (ids <= self.last[query]))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.ids, ids)))
        order = np.lexsort((ids, ~score, query))
        query, score, ids = query[order], score[order], ids[order]
        start = np.searchsorted(query, query)
        keep = np.arange(len(query)) - start < self.k
        self.query, self.score, self.ids = query[keep], score[keep], ids[keep]
        last = np.flatnonzero(np.arange(len(query))[keep] - start[keep] == self.k - 1)
        full = self.query[last]
        self.floor[full], self.last[full] = self.score[last], self.ids[last]


class Side:
    """Rows of a block: ids, integral vectors, rotated coordinates, lengths of what is left
    after each head."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, turn: np.ndarray):
        self.ids, self.x, self.y = ids, x, x @ turn
        width = x.shape[1]
        self.heads = sorted({max(1, width // 4), max(1, width // 2)})
        squares = np.cumsum(self.y[:, ::-1] ** 2, axis=1)[:, ::-1]
        self.whole = np.sqrt(squares[:, 0])
        self.rest = {h: np.sqrt(squares[:, h]) if h < width else np.zeros(len(x)) for h in self.heads}


def search(best: Best, queries: Side, candidates: Side) -> None:
    """Brings ``best`` up to date with a block of candidates."""
    for a in range(0, len(candidates.ids), STEP):
        cut = slice(a, min(a + STEP, len(candidates.ids)))
        longest = candidates.whole[cut].max(initial=0.0)
        near = np.flatnonzero(queries.whole * longest * (1.0 + MARGIN) >= best.floor)
        for b in range(0, len(near), STEP):
            step(best, queries, candidates, near[b : b + STEP], cut)


def step(best: Best, queries: Side, candidates: Side, q: np.ndarray, cut: slice) -> None:
    room = np.outer(queries.whole[q], candidates.whole[cut])
    slack = MARGIN * room
    alive = room + slack >= best.floor[q][:, None]
    alive &= (queries.ids[q][:, None] != candidates.ids[cut][None, :]) | (candidates.ids[cut] == NO_ID)[None, :]
    for h in queries.heads:
        upper = queries.y[q, :h] @ candidates.y[cut, :h].T + np.outer(queries.rest[h][q], candidates.rest[h][cut])
        alive &= upper + slack >= best.floor[q][:, None]
    i, j = np.nonzero(alive)
    if len(i) == 0:
        return
    xq, xc = queries.x[q], candidates.x[cut]
    if len(i) * 8 > alive.size and np.abs(xq).max() * np.abs(xc).max() * xq.shape[1] < 2.0**53:
        score = (xq @ xc.T)[i, j].astype(np.int64)
    else:
        score = np.concatenate([products(xq[i[n : n + 65536]], xc[j[n : n + 65536]]) for n in range(0, len(i), 65536)])
    ids = candidates.ids[cut][j]
    wins = best.wins(q[i], score, ids)
    if wins.any():
        best.add(q[i][wins], score[wins], ids[wins])


def narrow(x: np.ndarray) -> np.ndarray:
    most = float(np.abs(x).max(initial=0.0))
    return x.astype(KINDS[2 if most < 2.0**15 else 4 if most < 2.0**31 else 8])


def binary_rows(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values in the narrowest type."""
    raw = narrow(x)
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * (raw.itemsize * raw.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())])


def wide(raw: bytes, size: int, width: int) -> np.ndarray:
    return np.frombuffer(raw, KINDS[size]).astype(np.float64).reshape(-1, width)


def unpacked(row: dict, turn: np.ndarray) -> Side:
    ids = np.frombuffer(row["ids"], np.int64)
    return Side(ids, wide(row["vectors"], len(row["vectors"]) // (len(ids) * len(turn)), len(turn)), turn)


BLOB = "block long, longest double, ids binary, vectors binary"


def blocks(batches: Iterator[pa.RecordBatch], rows: int, width: int) -> Iterator[pa.RecordBatch]:
    """Packs (key, length, x) rows of a task into blocks, in order."""
    held: list[pa.RecordBatch] = []
    size, made = 0, 0

    def pack() -> Iterator[pa.RecordBatch]:
        nonlocal made
        table = pa.Table.from_batches(held).combine_chunks()
        x = np.concatenate([wide(raw, len(raw) // width, width) for raw in table.column("x").to_pylist()])
        ids = table.column("key").fill_null(int(NO_ID)).to_numpy().astype(np.int64)
        block = (TaskContext.get().partitionId() << 32) + made
        made += 1
        yield pa.RecordBatch.from_pydict(
            {"block": [block], "longest": [float(np.max(table.column("length").to_numpy()))], "ids": [ids.tobytes()], "vectors": [narrow(x).tobytes()]}
        )

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            take = min(rows - size, batch.num_rows - at)
            held.append(batch.slice(at, take))
            at, size = at + take, size + take
            if size == rows:
                yield from pack()
                held, size = [], 0
    if held:
        yield from pack()


def top_k(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every row whose id ``every`` divides."""
    spark, source = df.sparkSession, doubles(df, key, vector)
    schema = f"query_id long, rank int, `{key}` long, score long"
    turn = rotation(source)
    if turn is None:
        return spark.createDataFrame([], schema)
    width = len(turn)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows, matrix = matrices(batch, width)
            x = integers(matrix)
            yield pa.RecordBatch.from_arrays([keys(batch, rows), pa.array(lengths(x)), binary_rows(x)], ["key", "length", "x"])

    whole = source.mapInArrow(vectors, "key long, length double, x binary")
    asked = source.filter(F.col("key") % every == 0).mapInArrow(vectors, whole.schema)
    lead = whole.orderBy(F.desc("length"), F.asc_nulls_last("key")).limit(LEAD).collect()
    first = Side(np.array([NO_ID if r.key is None else r.key for r in lead], np.int64),
                 np.concatenate([wide(r.x, len(r.x) // width, width) for r in lead] or [np.zeros((0, width))]), turn)

    # Blocks of even size by dealing rows in turn; a block per task.
    query_blocks = max(1, -(-asked.count() // QUERIES))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in blocks(batches, 2**31, width):
            row = one.to_pylist()[0]
            side = unpacked(row, turn)
            best = Best(len(side.ids), k)
            search(best, side, first)
            need = np.where(side.whole > 0.0, best.floor / np.maximum(side.whole, 1e-300), -np.inf).min()
            yield pa.RecordBatch.from_pydict(
                {"query_block": [TaskContext.get().partitionId()], "need": [float(need)], "ids": [row["ids"]],
                 "vectors": [row["vectors"]], "floors": [best.floor.tobytes()]}
            )

    questions = cut_lineage(
        asked.repartition(query_blocks).mapInArrow(ask, "query_block long, need double, ids binary, vectors binary, floors binary")
    )
    share = -(-partitions(spark) // query_blocks)
    sorted_rows = whole.repartitionByRange(
        partitions(spark), F.desc("length"), F.asc("key"), F.hash(F.monotonically_increasing_id())
    ).sortWithinPartitions(F.desc("length"), F.asc_nulls_last("key"))
    candidates = cut_lineage(sorted_rows.mapInArrow(lambda batches: blocks(batches, BLOCK, width), BLOB))
    # One row per pair of blocks that can meet; a query block's pairs are dealt to ``share`` tasks.
    reach = questions.select("query_block", "need")
    pairs = (
        candidates.select("block", "longest", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<long>")).alias("query_block"))
        .join(reach, "query_block").filter(F.col("longest") * (1.0 + MARGIN) >= F.col("need"))
        .select("query_block", F.pmod(F.xxhash64("block"), F.lit(share)).cast("int").alias("lane"), "block")
    )
    work = pairs.join(candidates, "block").select(
        "query_block", "lane", F.lit(1).alias("kind"), "longest", "block", "ids", "vectors", F.lit(None).cast("binary").alias("floors")
    )
    asks = questions.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(share - 1)))).select(
        "query_block", "lane", F.lit(0).alias("kind"), F.lit(0.0).alias("longest"), F.lit(0).cast("long").alias("block"), "ids", "vectors", "floors"
    )
    lanes = query_blocks * share
    met = work.unionAll(asks).repartitionById(lanes, (F.col("query_block") * share + F.col("lane")).cast("int")).sortWithinPartitions(
        "query_block", "lane", "kind", F.desc("longest"), "block"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side: Side | None = None
        best: Best | None = None
        place = (0, 0)

        def answer() -> Iterator[pa.RecordBatch]:
            if side is not None and len(best.query):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best.query), place[0]), pa.int64()), pa.array(best.query, pa.int64()),
                     pa.array(side.ids[best.query]), pa.array(best.ids, mask=best.ids == NO_ID), pa.array(best.score)],
                    ["query_block", "place", "query_id", "found", "score"],
                )

        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                if row["kind"] == 0:
                    yield from answer()
                    place, side = (row["query_block"], row["lane"]), unpacked(row, turn)
                    best = Best(len(side.ids), k)
                    best.floor = np.frombuffer(row["floors"]).copy()
                else:
                    search(best, side, unpacked(row, turn))
        yield from answer()

    found = met.mapInArrow(run, "query_block long, place long, query_id long, found long, score long")
    order = Window.partitionBy("query_block", "place").orderBy(F.desc("score"), F.asc_nulls_last("found"))
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("found").alias(key), "score")
    )
