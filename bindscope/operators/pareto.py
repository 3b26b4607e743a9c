"""Pareto fronts on two scores, larger is better; equal points share a front.

A point's front is 1 + the largest front among the points that dominate it. Points of a
group are placed in a grid: column i holds the i-th ``block`` of points by falling x,
row j the j-th by falling y (each order breaks ties by the other score, so a dominator
comes first in both). Only cells to the left and above can dominate a cell, so the cells
of one anti-diagonal are independent: a group with B columns takes 2B - 1 rounds, however
many fronts it has. A cell gets from its row the best y reached by each front, from its
column the best x, and one number for all cells both left and above. Inside, points are
taken by falling x, and the fronts' best y is kept sorted: n log n.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bindscope.operators.ranking import add_rank, group_text
from bindscope.session import cut_lineage, scratch

#: Rows of a cell: its points, best y by front from its row, best x by front from its
#: column, the best front of all cells before it in both, and the cell's own best front.
POINT, ROW, COLUMN, CORNER, TOP = range(5)
STATE = "g string, i long, j long, kind int, x double, y double, front long, right long, below long, at long"
DONE, TOPS = -1, -2


class Stairs:
    """Best value reached by a front or a later one: fronts rise, values fall."""

    def __init__(self, fronts: list[int], values: list[float]):
        self.fronts, self.negative = [], []
        for value, front in sorted(zip(values, fronts), key=lambda p: (-p[0], -p[1])):
            if not self.fronts or front > self.fronts[-1]:
                self.fronts.append(front)
                self.negative.append(-value)

    def reached(self, value: float) -> int:
        """Largest front with a value of at least this."""
        k = bisect_right(self.negative, -value)
        return self.fronts[k - 1] if k else 0

    def add(self, front: int, value: float) -> None:
        """``front`` must be above what ``reached(value)`` gives."""
        low, high = bisect_left(self.negative, -value), bisect_right(self.fronts, front)
        self.fronts[low:high], self.negative[low:high] = [front], [-value]


def cell_fronts(x: np.ndarray, y: np.ndarray, row: Stairs, column: Stairs, corner: int) -> np.ndarray:
    """Fronts of a cell's points, given in (x, y) descending order; ``row`` takes them in."""
    out = np.empty(len(x), np.int64)
    for n, (a, b) in enumerate(zip(x.tolist(), y.tolist())):
        out[n] = front = 1 + max(corner, row.reached(b), column.reached(a))
        row.add(front, b)
    return out


def layer_numbers(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Front of each distinct point, given in (x, y) descending order."""
    return cell_fronts(x, y, Stairs([], []), Stairs([], []), 0)


def layer_cell(cell: pa.Table) -> pa.Table:
    """Numbers the points of a cell and addresses what its right and lower neighbours need."""
    kind, x, y = (cell.column(c).to_numpy() for c in ("kind", "x", "y"))
    front = cell.column("front").fill_null(0).to_numpy()
    own = np.flatnonzero(kind == POINT)
    own = own[np.lexsort((-y[own], -x[own]))]
    place = {c: cell.column(c)[int(own[0])].as_py() for c in ("g", "i", "j", "right", "below")}
    stairs = {k: Stairs(front[kind == k].tolist(), v[kind == k].tolist()) for k, v in ((ROW, y), (COLUMN, x))}
    corner = int(front[kind == CORNER].max(initial=0))
    found = cell_fronts(x[own], y[own], stairs[ROW], stairs[COLUMN], corner)
    # What this cell tells: (row, column, kind, x, y, front, address).
    told = [(np.full(len(own), place["i"]), np.full(len(own), place["j"]), POINT, x[own], y[own], found, DONE)]
    one = np.zeros(1)
    told.append((np.array([place["i"]]), np.array([place["j"]]), TOP, one, one, found.max(keepdims=True), TOPS))
    if place["right"] is not None:
        f, v = np.array(stairs[ROW].fronts), -np.array(stairs[ROW].negative)
        told.append((np.full(len(f), place["right"]), np.full(len(f), place["j"]), ROW, np.zeros(len(f)), v, f, place["right"] + place["j"]))
    if place["below"] is not None:
        column = Stairs(stairs[COLUMN].fronts + found.tolist(), [-v for v in stairs[COLUMN].negative] + x[own].tolist())
        f, v = np.array(column.fronts), -np.array(column.negative)
        told.append((np.full(len(f), place["i"]), np.full(len(f), place["below"]), COLUMN, v, np.zeros(len(f)), f, place["i"] + place["below"]))
    sizes = [len(t[0]) for t in told]
    total = sum(sizes)
    join = lambda n: np.concatenate([np.asarray(t[n]) for t in told])
    nothing = pa.nulls(total, pa.int64())
    return pa.Table.from_arrays(
        [pa.array([place["g"]] * total), pa.array(join(0), pa.int64()), pa.array(join(1), pa.int64()),
         pa.array(np.repeat([t[2] for t in told], sizes), pa.int32()), pa.array(join(3), pa.float64()), pa.array(join(4), pa.float64()),
         pa.array(join(5), pa.int64()), nothing, nothing, pa.array(np.repeat([t[6] for t in told], sizes), pa.int64())],
        ["g", "i", "j", "kind", "x", "y", "front", "right", "below", "at"],
    )


def _solve(cells: DataFrame) -> DataFrame:
    return cells.groupBy("g", "i", "j").applyInArrow(layer_cell, STATE)


def _cells(points: DataFrame, block: int) -> DataFrame:
    """Points with their cell, and the next cells that have points, right and below."""
    ranked = add_rank(points, [-F.col("x"), -F.col("y")], "rx", by=["g"])
    ranked = add_rank(ranked, [-F.col("y"), -F.col("x")], "ry", by=["g"], sample=points)
    cell = lambda r: F.floor((F.col(r) - 1) / block)
    placed = cut_lineage(ranked.select("g", cell("rx").alias("i"), cell("ry").alias("j"), "x", "y"))
    used = placed.select("g", "i", "j").distinct()
    used = used.withColumn("right", F.lead("i").over(Window.partitionBy("g", "j").orderBy("i")))
    used = used.withColumn("below", F.lead("j").over(Window.partitionBy("g", "i").orderBy("j")))
    return cut_lineage(placed.join(used, ["g", "i", "j"]))


def _state(cells: DataFrame) -> DataFrame:
    return cells.select(
        "g", "i", "j", F.lit(POINT).alias("kind"), "x", "y", F.lit(None).cast("long").alias("front"), "right", "below",
        (F.col("i") + F.col("j")).alias("at"),
    )


def numbered(points: DataFrame, block: int) -> DataFrame:
    """(g, x, y, front) of distinct points (g, x, y)."""
    if points.groupBy("g").count().filter(F.col("count") > block).isEmpty():
        # Every group is one cell: the first round is the last.
        origin = F.lit(0).cast("long")
        nothing = F.lit(None).cast("long")
        cells = points.select("g", origin.alias("i"), origin.alias("j"), "x", "y", nothing.alias("right"), nothing.alias("below"))
        return _solve(_state(cells)).filter(F.col("at") == DONE).select("g", "x", "y", "front")
    spark = points.sparkSession
    state = _state(_cells(points, block))
    path = scratch(spark, "fronts")
    rounds = [r["at"] for r in state.select("at").distinct().orderBy("at").collect()]  # at most 2B - 1
    for n, at in enumerate(rounds):
        cells = state.filter(F.col("at") == at)
        if n:
            told = spark.read.schema(STATE).parquet(path)
            here = cells.select("g", "i", "j").distinct()
            tops = told.filter(F.col("at") == TOPS).select("g", F.col("i").alias("a"), F.col("j").alias("b"), F.col("front").alias("top"))
            corner = here.join(tops, "g").filter("a < i and b < j").groupBy("g", "i", "j").agg(F.max("top").alias("front"))
            cells = cells.unionByName(told.filter(F.col("at") == at)).unionByName(
                corner.withColumn("kind", F.lit(CORNER)), allowMissingColumns=True
            )
        _solve(cells).write.mode("append").partitionBy("at").parquet(path)
    return spark.read.schema(STATE).parquet(path).filter(F.col("at") == DONE).select("g", "x", "y", "front")


def pareto_fronts(df: DataFrame, x: str, y: str, by: Sequence[str] = (), eligible: str | None = None, block: int = 100_000) -> DataFrame:
    """Adds ``pareto_front``. Only distinct score pairs are numbered, then joined back; rows
    that are not eligible, or miss a score (null or NaN), get null. A cell of the grid, which
    one task holds, has at most ``block`` points."""
    usable = F.coalesce(~F.isnan(x) & ~F.isnan(y), F.lit(False))
    if eligible is not None:
        usable = usable & F.coalesce(F.col(eligible), F.lit(False))
    group = F.concat_ws("\x1f", F.lit(""), *[group_text(c) for c in by])
    keyed = df.withColumn("__g", F.when(usable, group)).withColumn("__x", F.col(x).cast("double")).withColumn("__y", F.col(y).cast("double"))
    points = keyed.filter("__g is not null").select(F.col("__g").alias("g"), (F.col("__x") + 0.0).alias("x"), (F.col("__y") + 0.0).alias("y"))
    fronts = numbered(cut_lineage(points.distinct()), block)
    fronts = fronts.select(F.col("g").alias("__g"), F.col("x").alias("__x"), F.col("y").alias("__y"), F.col("front").alias("pareto_front"))
    return keyed.join(fronts, ["__g", "__x", "__y"], "left").select(*df.columns, "pareto_front")
