"""Merkle manifest of a table, with an octopus multiproof for each run of leaves.

A row is a leaf. Leaves of one tree (a language) are ordered by one range exchange and
packed as runs, at most ``RUN`` consecutive leaves each, so that only counts are needed to
place them. A run hashes every node that its leaves determine; the topmost of these meet in
rounds of small groups (all below one ancestor), which give the nodes above them. A run
then names the nodes its proofs lack: at each level at most the left neighbour of its first
node and the right neighbour of its last. It gets them by one join, derives the shared
interior nodes, and writes out the proof of each of its leaves, which is folded to a root
again. The roots of the trees are the leaves of one more tree, built the same way.

Odd input: nulls are hashed as ``-``; a null language is a tree of its own and comes first,
a null id comes first in its tree; equal ids go by their leaf hashes, equal rows are leaves
of equal hash (any order gives the same rows). A row without id is never altered by
``tampered``. Other columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindscope.llm.shared import DOCUMENT, partitions
from bindscope.session import cut_lineage

#: Leaves of a run at most, and levels that a round of grouping climbs.
RUN, CLIMB = 1 << 14, 8
Node = bytes  # a digest as hex text
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*nodes: Node) -> Node:
    return sha256(b"".join(nodes)).hexdigest().encode()


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256)


def tree_key(name: Column) -> Column:
    """Never null; sorts null first, then by bytes."""
    return F.when(name.isNull(), "-").otherwise(F.concat(F.lit("="), name))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, id, leaf, altered): altered is the leaf after n_chars grew by one, where 7
    divides the id's crc32; else null."""
    rows = docs.select(*DOCUMENT)
    grown = (F.col("n_chars").cast("decimal(20,0)") + F.lit(1)).cast("decimal(20,0)")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return rows.select(
        tree_key(F.col("lang")).alias("tree"), F.col("doc_id").cast("string").alias("id"), F.col("doc_id").cast("long").alias("place"),
        F.unhex(leaf_hash([F.col(c) for c in FIELDS])).alias("leaf"),
        F.when(hit, F.unhex(leaf_hash([grown if c == "n_chars" else F.col(c) for c in FIELDS]))).alias("altered"),
    )


PACKED = "part int, run int, tree string, n int, ids array<string>, leaves array<binary>, altered array<binary>"


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of the sorted rows of a task."""
    part, run = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []
    size, tree = 0, None

    def write() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()

        def one(name: str, kind: pa.DataType) -> pa.Array:
            values = table.column(name).combine_chunks().cast(kind)
            return pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), values)

        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([run], pa.int32()), pa.array([tree]), pa.array([size], pa.int32()),
             one("id", pa.string()), one("leaf", pa.binary()), one("altered", pa.binary())],
            ["part", "run", "tree", "n", "ids", "leaves", "altered"],
        )

    for batch in batches:
        names = np.array(batch.column(0).to_pylist(), dtype=object)
        cuts = np.concatenate([[0], np.flatnonzero(names[1:] != names[:-1]) + 1, [len(names)]]).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            while a < b:
                if held and (names[a] != tree or size == RUN):
                    yield write()
                    held, size, run = [], 0, run + 1
                tree = names[a]
                take = min(b - a, RUN - size)
                held.append(batch.slice(a, take))
                a, size = a + take, size + take
    if held:
        yield write()


class Run:
    """The leaves at [start, start + n) of a tree of ``total`` leaves, and the nodes known
    from them: ``levels[l]`` is the first index at that level and the nodes from there."""

    def __init__(self, start: int, total: int, nodes: list[Node]):
        self.start, self.stop, self.total = start, start + len(nodes), total
        self.height = (total - 1).bit_length()
        self.levels = [(start, nodes)]

    def count(self, level: int) -> int:
        """Nodes of the whole tree at a level."""
        return -(-self.total // (1 << level))

    def own(self) -> Iterator[tuple[int, int, Node]]:
        """The topmost nodes (level, index, node) that these leaves alone determine."""
        level, (first, nodes) = 0, self.levels[0]
        while nodes:
            last = first + len(nodes) - 1
            whole = last + 1 == self.count(level)
            if level == self.height:
                yield level, first, nodes[0]
                return
            if first % 2:
                yield level, first, nodes[0]
            if last % 2 == 0 and not whole and (last > first or first % 2 == 0):
                yield level, last, nodes[-1]
            a, b = first % 2, len(nodes)
            above = [digest(*nodes[i : i + 2]) for i in range(a, b - 1, 2)]
            if whole and last % 2 == 0 and (b - a) % 2:
                above.append(digest(nodes[-1]))
            level, first, nodes = level + 1, (first + 1) // 2, above

    def lacking(self) -> Iterator[tuple[int, int]]:
        """(level, index) of the nodes that the proofs of these leaves need beside them."""
        for level in range(self.height):
            first, last = self.start >> level, (self.stop - 1) >> level
            if first % 2:
                yield level, first - 1
            if last % 2 == 0 and last + 1 < self.count(level):
                yield level, last + 1

    def complete(self, fetched: dict[tuple[int, int], Node]) -> None:
        """All nodes on the ways from these leaves to the root, and their siblings."""
        for level in range(self.height):
            first, nodes = self.levels[level]
            left, right = fetched.get((level, first - 1)), fetched.get((level, first + len(nodes)))
            if first % 2:
                first, nodes = first - 1, [left, *nodes]
            if right is not None:
                nodes = [*nodes, right]
            self.levels[level] = first, nodes
            self.levels.append((first // 2, [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]))

    def proof(self, at: int) -> list[Node]:
        """Siblings of the leaf at a position, from its level up."""
        found = []
        for level in range(self.height):
            first, nodes = self.levels[level]
            beside = ((at >> level) ^ 1) - first
            if beside < len(nodes):
                found.append(nodes[beside])
        return found


def folded(node: Node, at: int, total: int, proof: Iterator[Node]) -> Node:
    """The root that a leaf and its siblings give."""
    while total > 1:
        if at % 2:
            node = digest(next(proof), node)
        elif at + 1 < total:
            node = digest(node, next(proof))
        else:
            node = digest(node)
        at, total = at // 2, (total + 1) // 2
    return node


def hexed(values: list[bytes]) -> list[Node]:
    return [v.hex().encode() for v in values]


class Forest:
    """Trees over (tree, id, place, leaf, altered) rows: ``runs`` holds the packed leaves,
    ``spans`` (part, run, tree, start, total) their places, ``nodes`` (tree, level, index,
    node) what other runs may ask for, ``roots`` (tree, total, root) the results."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        order = ["tree", "place", "id", "leaf", "row"]
        numbered = cut_lineage(rows).withColumn("row", F.monotonically_increasing_id())
        dealt = numbered.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
        self.runs = cut_lineage(dealt.select("tree", "id", "leaf", "altered").mapInArrow(pack, PACKED))
        tree = Window.partitionBy("tree")
        before = F.sum("n").over(tree.orderBy("part", "run").rowsBetween(Window.unboundedPreceding, -1))
        # One row per run: at most a RUN-th of the leaves, besides one per tree and partition.
        self.spans = cut_lineage(self.runs.select("part", "run", "tree", "n").select(
            "part", "run", "tree", F.coalesce(before, F.lit(0)).alias("start"), F.sum("n").over(tree).alias("total")
        ))
        self.climb()

    def placed(self) -> DataFrame:
        return self.runs.join(self.spans.drop("tree"), ["part", "run"])

    def climb(self) -> None:
        def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    own = list(Run(row["start"], row["total"], hexed(row["leaves"])).own())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["tree"]] * len(own), pa.string()), pa.array([row["total"]] * len(own), pa.int64()),
                         pa.array([x[0] for x in own], pa.int32()), pa.array([x[1] for x in own], pa.int64()),
                         pa.array([x[2].decode() for x in own], pa.string())],
                        ["tree", "total", "level", "index", "node"],
                    )

        schema = "tree string, total long, level int, index long, node string"
        level = cut_lineage(self.placed().select("tree", "start", "total", "leaves").mapInArrow(tops, schema))
        size = self.spans.agg(F.max("total").alias("most"), F.sum(F.lit(1)).alias("runs")).first()
        height, leaf_count = ((size.most or 1) - 1).bit_length(), self.runs.agg(F.sum("n")).first()[0] or 0
        goal = max(1, (leaf_count // max(size.runs or 0, 1)).bit_length() + 4)
        every = level
        while True:
            to = min(goal, height)
            below = level.filter(F.col("level") < to)
            made = below.withColumn("above", F.expr(f"shiftright(index, {to} - level)")).groupBy("tree", "above").applyInArrow(raising(to), schema)
            made = cut_lineage(made)
            every = every.unionAll(made)
            level = level.filter(F.col("level") >= to).unionAll(made.filter(f"level = least({to}, {HEIGHT})"))
            if to == height:
                break
            goal = to + CLIMB
        self.nodes = every
        self.roots = every.filter(f"level = {HEIGHT}").select("tree", "total", F.col("node").alias("root"))

    def proofs(self, above: DataFrame | None = None) -> DataFrame:
        """(tree, id, position, total, leaf, proof, subroot, root, altered_root): siblings of each leaf up to the
        root. With ``above``, (tree, total, position, proof, root) of each tree's root in a
        further one, proofs go on to that one's root. altered_root is folded from the altered
        leaf where there is one, else from the leaf."""
        def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    run = Run(r["start"], r["total"], [b""] * r["n"])
                    lacks = list(run.lacking())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["part"]] * len(lacks), pa.int32()), pa.array([r["run"]] * len(lacks), pa.int32()),
                         pa.array([r["tree"]] * len(lacks), pa.string()),
                         pa.array([x[0] for x in lacks], pa.int32()), pa.array([x[1] for x in lacks], pa.int64())],
                        ["part", "run", "tree", "level", "index"],
                    )

        spans = self.spans.join(self.runs.select("part", "run", "n"), ["part", "run"])
        asked = spans.select("part", "run", "tree", "n", "start", "total").mapInArrow(
            coordinates, "part int, run int, tree string, level int, index long"
        )
        got = asked.join(self.nodes.select("tree", "level", "index", "node"), ["tree", "level", "index"])
        got = got.groupBy("part", "run").agg(F.collect_list(F.struct("level", "index", "node")).alias("fetched"))
        info = self.spans.join(got, ["part", "run"], "left")
        if above is None:
            info = info.select("*", F.lit(0).cast("long").alias("top_at"), F.lit(1).cast("long").alias("top_total"), F.array().cast("array<string>").alias("top"))
        else:
            info = info.join(above, "tree")
        work = self.runs.drop("tree").join(info, ["part", "run"])

        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield expanded(row)

        return work.mapInArrow(
            expand, "tree string, id string, position long, total long, leaf string, proof array<string>, subroot string, root string, altered_root string"
        )


#: Height of a tree of ``total`` leaves, in SQL.
HEIGHT = "cast(length(bin(total - 1)) - if(total = 1, 1, 0) as int)"


def raising(to: int) -> Callable[[pa.Table], pa.Table]:
    return lambda group: raised(group, to)


def raised(group: pa.Table, to: int) -> pa.Table:
    """Nodes above those given, up to level ``to``; all under one ancestor at that level."""
    rows = group.to_pylist()
    total, tree = rows[0]["total"], rows[0]["tree"]
    to = min(to, (total - 1).bit_length())
    waiting: dict[int, dict[int, Node]] = {}
    for row in rows:
        waiting.setdefault(row["level"], {})[row["index"]] = row["node"].encode()
    out: list[tuple[int, int, Node]] = []
    for level in range(min(waiting), to):
        here = waiting.get(level, {})
        last = -(-total // (1 << level)) - 1
        for index, node in here.items():
            if index % 2 == 0 and (index + 1 in here or index == last):
                beside = [here[index + 1]] if index + 1 in here else []
                above = digest(node, *beside)
                waiting.setdefault(level + 1, {})[index // 2] = above
                out.append((level + 1, index // 2, above))
    return pa.Table.from_arrays(
        [pa.array([tree] * len(out), pa.string()), pa.array([total] * len(out), pa.int64()), pa.array([x[0] for x in out], pa.int32()),
         pa.array([x[1] for x in out], pa.int64()), pa.array([x[2].decode() for x in out], pa.string())],
        ["tree", "total", "level", "index", "node"],
    )


def expanded(row: dict) -> pa.RecordBatch:
    """The proofs of a run, and what they fold to."""
    nodes = hexed(row["leaves"])
    run = Run(row["start"], row["total"], nodes)
    run.complete({(x["level"], x["index"]): x["node"].encode() for x in row["fetched"] or ()})
    top = [x.encode() for x in row["top"]]
    subroot = run.levels[-1][1][0]
    root = folded(subroot, row["top_at"], row["top_total"], iter(top))
    proofs, results = [], []
    for i, node in enumerate(nodes):
        at = run.start + i
        proof = run.proof(at)
        start = node if row["altered"][i] is None else row["altered"][i].hex().encode()
        low = iter(proof)
        results.append(folded(folded(start, at, run.total, low), row["top_at"], row["top_total"], iter(top)))
        proofs.append([x.decode() for x in proof] + row["top"])
    n = len(nodes)
    return pa.RecordBatch.from_arrays(
        [pa.array([row["tree"]] * n), pa.array(row["ids"], pa.string()), pa.array(np.arange(run.start, run.stop), pa.int64()),
         pa.array([run.total] * n, pa.int64()), pa.array([x.decode() for x in nodes]), pa.array(proofs, pa.list_(pa.string())), pa.array([subroot.decode()] * n),
         pa.array([root.decode()] * n), pa.array([x.decode() for x in results])],
        ["tree", "id", "position", "total", "leaf", "proof", "subroot", "root", "altered_root"],
    )


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, position, leaf, proof, subroot, root, folded_root, verified) per row: its
    place in its language's tree, its siblings up to the root of all, and the root that its
    proof gives after the alteration named in ``leaves``."""
    trees = Forest(leaves(docs))
    names = trees.roots.select(
        F.lit("=").alias("tree"), F.col("tree").alias("id"), F.lit(0).cast("long").alias("place"),
        F.unhex("root").alias("leaf"), F.lit(None).cast("binary").alias("altered"),
    )
    union = Forest(names)
    above = union.proofs().select(
        F.col("id").alias("tree"), F.col("position").alias("top_at"), F.col("total").alias("top_total"), F.col("proof").alias("top")
    )
    return trees.proofs(above).select(
        F.col("id").cast("long").alias("doc_id"), "position", "leaf", "proof", "subroot", "root",
        F.col("altered_root").alias("folded_root"), (F.col("altered_root") == F.col("root")).alias("verified"),
    )
