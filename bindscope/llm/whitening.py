"""Whitening of embeddings by a bidiagonal qd solver.

Entries become integers, so their sums over all rows are exact. Every task then folds its
centred rows, block by block, into a triangle R by QR; triangles meet in a tree of
exchanges, a triangle being nothing but at most d more rows. The last one (d x d, d being
the width of a vector) is reduced to bidiagonal form by Householder reflections. Its
singular values come from dqds: shifts are accepted only while all quotients stay
positive, and a Newton bound is the shift that never fails. Each direction is read from a
twisted factorisation at the value found, the twist being where the pivot is least.

Odd input: rows whose vector is null, empty, or holds null or non-finite entries are
dropped. The fit list has one width: the one most rows have (the larger on a tie); rows of
another width are dropped too. A row without id is kept with its null id, a repeated row
counts and is returned as often as it occurs, other columns are ignored, an empty table
gives no rows. Entries are held to +-2^62 before the sums. Directions without extent
(fewer independent rows than components) have explained 0, or null if all rows are equal,
and whitened null; they don't count in identity_error, which is null if none is left. Equal
eigenvalues give some orthonormal basis of their space. A deviation beyond 64 bits is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindscope.llm.shared import partitions
from bindscope.llm.vectors import doubles, keys, list_rows, matrices, pieces, usable
from bindscope.session import cut_lineage

#: Quantisation of the entries: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
BLOCK, FAN = 2048, 16
EPS = float(np.finfo(float).eps)
LONG = 2**63 - 1


@dataclass
class Model:
    """The fit: row count, exact sums, and per component a direction and an eigenvalue."""

    count: int
    sums: list[int]
    directions: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None = None


def integers(matrix: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * matrix), -(2.0**62), 2.0**62).astype(np.int64) + OFFSET


def scaled(x: np.ndarray, count: int, sums: list[int]) -> np.ndarray:
    """count * x - sums, exactly: 64-bit integers where they suffice, else Python's."""
    most = int(np.abs(x).max(initial=0)) * count
    if most + max(map(abs, sums), default=0) < 2**62:
        return count * x - np.array(sums, np.int64)
    return count * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, count: int, sums: list[int]) -> np.ndarray:
    return (scaled(x, count, sums) / count).astype(np.float64)


def deviations(exact: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, null beyond 64 bits."""
    most = float(np.abs(exact).max(initial=0))
    if exact.dtype != object and most * most * exact.shape[1] < 2.0**62:
        return np.einsum("ij,ij->i", exact, exact).tolist()
    rows = [sum(int(v) ** 2 for v in row) for row in exact]
    return [v if v <= LONG else None for v in rows]


def totals(df: DataFrame) -> DataFrame:
    """(width, dim, n, s): rows of that width, and the exact sum of the entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}
        for batch in pieces(batches):
            _, sizes, _ = usable(batch)
            for width in np.unique(sizes).tolist():
                x = integers(matrices(batch, width)[1])
                high, low = (x >> 31).sum(axis=0).tolist(), (x & (2**31 - 1)).sum(axis=0).tolist()
                n, sums = held.get(width, (0, [0] * width))
                held[width] = n + len(x), [s + (h << 31) + w for s, h, w in zip(sums, high, low)]
        for width, (n, sums) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([width] * width, pa.int32()), pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()),
                 pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))],
                ["width", "dim", "n", "s"],
            )

    parts = df.mapInArrow(run, "width int, dim int, n long, s decimal(38,0)")
    return parts.groupBy("width", "dim").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))


def triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def fold(blocks: Iterator[np.ndarray], width: int) -> np.ndarray:
    """R of all rows, a block at a time."""
    r, held, size = np.zeros((0, width)), [], 0
    for block in blocks:
        held.append(block)
        size += len(block)
        if size >= max(BLOCK, 2 * width):
            r, held, size = triangle(np.concatenate([r, *held])), [], 0
    return triangle(np.concatenate([r, *held])) if held else r


def corner(df: DataFrame, count: int, sums: list[int]) -> np.ndarray:
    """R (d x d) of the centred rows."""
    width = len(sums)

    def emit(r: np.ndarray) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([node] * len(r), pa.int32()), list_rows(r)], ["node", "row"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit(fold((centred(integers(matrices(b, width)[1]), count, sums) for b in pieces(batches)), width))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[np.ndarray]:
            for b in batches:
                yield b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

        yield from emit(fold(rows(), width))

    schema = "node int, row array<double>"
    rows, k = df.mapInArrow(first, schema), partitions(df.sparkSession)
    while k > 1:
        k = -(-k // FAN)
        rows = rows.repartitionById(k, F.col("node") % k).mapInArrow(merge, schema)
    found = [r.row for r in rows.select("row").toLocalIterator()]
    r = triangle(np.array(found, float).reshape(-1, width)) if found else np.zeros((0, width))
    return np.concatenate([r, np.zeros((width - len(r), width))])


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v, tau with (I - tau v v') x a multiple of the first unit vector."""
    v = x / (np.abs(x).max(initial=0.0) or 1.0)
    norm = math.sqrt(float(v @ v))
    if norm == 0.0:
        return v, 0.0
    v[0] += math.copysign(norm, v[0])
    return v, 2.0 / float(v @ v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, float]]]:
    """Diagonal, upper diagonal and the right reflections of R = U B W'."""
    a, d, right = r.copy(), len(r), []
    for k in range(d):
        v, tau = reflector(a[k:, k])
        a[k:, k:] -= tau * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v, tau = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= tau * np.outer(a[k:, k + 1 :] @ v, v)
            right.append((k + 1, v, tau))
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd transform with a shift: the new array, and the sum of the
    reciprocal pivots; None where a quotient turns negative."""
    d, new_q, new_e, inverse = q[0] - shift, [], [], 0.0
    for i in range(len(e)):
        if d < 0.0:
            return None
        inverse += 1.0 / d if d > 0.0 else math.inf
        p = d + e[i]
        if p == 0.0:  # an exact zero: the array splits here
            ratio, low, d = 0.0, 0.0, q[i + 1] - shift
        else:
            ratio = q[i + 1] / p
            low, d = e[i] * ratio, d * ratio - shift
        new_q.append(p)
        new_e.append(low)
    if not d >= 0.0:
        return None
    new_q.append(d)
    return new_q, new_e, inverse + (1.0 / d if d > 0.0 else math.inf)


def shift_guess(q: list[float], e: list[float]) -> float:
    """Least eigenvalue of the last 2 x 2 block, less what its neighbour can take from it."""
    a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    half = (a - b) / 2.0
    root = math.hypot(half, math.sqrt(c))
    low = b - c / (half + root) if half + root > 0.0 else b
    if len(e) < 2:
        return low
    a, t = q[-2] + e[-2], q[-3] * e[-2]
    gap = max(a - low, EPS * a)
    return low - 2.0 * t * (c / (gap * gap + c)) / max(q[-3] - low, gap)


def squared_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, descending, by dqds."""
    scale = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(upper).max(initial=0.0)))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    work = [([float(v / scale) ** 2 for v in diagonal], [float(v / scale) ** 2 for v in upper], 0.0)]
    found: list[float] = []
    rounds, most = 0, 100 * len(diagonal) + 1000
    while work:
        q, e, base = work.pop()
        cut = next((i for i, low in enumerate(e) if low <= EPS * EPS * (base + min(q[i], q[i + 1])) or low < 1e-300), None)
        if not e:
            found.append(base + q[0])
            continue
        if cut is not None:
            work += [(q[: cut + 1], e[:cut], base), (q[cut + 1 :], e[cut + 1 :], base)]
            continue
        rounds += 1
        if rounds > most:
            raise ArithmeticError("dqds did not converge")
        if q[-1] > 1.5 * q[0]:
            q, e = q[::-1], e[::-1]
        guess = shift_guess(q, e)
        shift, step = guess, qd_step(q, e, guess) if guess > 0.0 else None
        if step is None:
            shift, step = 0.0, qd_step(q, e, 0.0)
            newton = (1.0 - 4.0 * EPS) / step[2]  # at most the least eigenvalue
            if newton > EPS * EPS * base and (better := qd_step(q, e, newton)) is not None:
                shift, step = newton, better
        work.append((step[0], step[1], base + shift))
    return np.sort(np.array(found))[::-1] * scale * scale


class Twisted:
    """N diag N' = B'B - value, twisted at the index of the least pivot."""

    def __init__(self, diagonal: np.ndarray, upper: np.ndarray, value: float):
        n = len(diagonal)
        q, e, cross = diagonal**2, upper**2, diagonal[: n - 1] * upper
        tiny = EPS * EPS * max(value, float(q.max(initial=0.0)), 1e-290)
        self.down, self.up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
        s, p = np.zeros(n), np.zeros(n)
        plus, minus = np.zeros(n), np.zeros(n)
        s[0] = -value
        for i in range(n - 1):
            plus[i] = s[i] + q[i] or -tiny
            self.down[i] = cross[i] / plus[i]
            s[i + 1] = e[i] * (s[i] / plus[i]) - value
        p[n - 1] = q[n - 1] - value
        for i in range(n - 2, -1, -1):
            minus[i + 1] = e[i] + p[i + 1] or -tiny
            self.up[i] = cross[i] / minus[i + 1]
            p[i] = q[i] * (p[i + 1] / minus[i + 1] if e[i] else 1.0) - value
        pivots = s + p + value
        self.at = int(np.argmin(np.abs(pivots)))
        self.pivots = np.where(np.arange(n) < self.at, plus, minus)
        self.pivots[self.at] = pivots[self.at] or tiny

    def spread(self, y: np.ndarray) -> np.ndarray:
        """x with N' x = y."""
        x = y.copy()
        for i in range(self.at - 1, -1, -1):
            x[i] -= self.down[i] * x[i + 1]
        for i in range(self.at, len(x) - 1):
            x[i + 1] -= self.up[i] * x[i]
        return x

    def vector(self) -> np.ndarray:
        y = np.zeros(len(self.pivots))
        y[self.at] = 1.0
        x = self.spread(y)
        return x / np.linalg.norm(x)

    def solve(self, b: np.ndarray) -> np.ndarray:
        y = b.copy()
        for i in range(self.at):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(len(y) - 2, self.at - 1, -1):
            y[i] -= self.up[i] * y[i + 1]
        return self.spread(y / self.pivots)


def right_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors of a bidiagonal matrix for its leading squared values, a
    row each. Values closer than a thousandth are kept orthogonal by inverse iteration."""
    scale = math.sqrt(values[0]) if len(values) and values[0] > 0.0 else 1.0
    diagonal, upper, values = diagonal / scale, upper / scale, values / (scale * scale)
    found: list[np.ndarray] = []
    for i, value in enumerate(values):
        factors = Twisted(diagonal, upper, float(value))
        near = [found[j] for j in range(i) if values[j] - value <= 1e-3 * max(values[j], EPS)]
        x = factors.vector()
        for attempt in range(8):
            before = np.linalg.norm(x)
            for _ in range(2):
                for other in near:
                    x = x - (other @ x) * other
            left = np.linalg.norm(x)
            if left > 0.1 * before:
                x = x / left
                break
            start = np.random.default_rng(attempt + 1).standard_normal(len(diagonal))
            for other in near:
                start -= (other @ start) * other
            x = factors.solve(start / np.linalg.norm(start))
        found.append(x / np.linalg.norm(x))
    return np.array(found).reshape(-1, len(diagonal))


def solve(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors of R, a row each, and their squared singular values;
    what rounding leaves of a zero is a zero, with no direction."""
    diagonal, upper, right = bidiagonal(r)
    values = squared_values(diagonal, upper)[:components]
    values = np.where(values > values[0] * (16.0 * EPS * len(r)) ** 2, values, 0.0)
    directions = np.zeros((len(values), len(r)))
    own = int(np.count_nonzero(values))
    directions[:own] = right_vectors(diagonal, upper, values[:own])
    for at, v, tau in reversed(right):
        directions[:, at:] -= tau * np.outer(directions[:, at:] @ v, v)
    return directions, values


def project(exact: np.ndarray, model: Model) -> np.ndarray:
    """Whitened coordinates; NaN in a direction without extent."""
    x = (exact / model.count).astype(np.float64)
    spread = np.sqrt(np.where(model.values > 0.0, model.values, np.nan))
    return (x @ model.directions.T) / spread


def identity_error(df: DataFrame, model: Model) -> float | None:
    """Largest entry of |covariance of the whitened rows - identity|. A task sends sums of
    products of its rows, which are centred already, and their sums for the small rest."""
    width, k = len(model.sums), len(model.values)
    own = [i for i in range(k) if model.values[i] > 0.0]
    if not own:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total = np.zeros((k, k)), np.zeros(k)
        for batch in pieces(batches):
            w = project(scaled(integers(matrices(batch, width)[1]), model.count, model.sums), model)
            gram += w.T @ w
            total += w.sum(axis=0)
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i, np.arange(k)]), pa.int32()), pa.array(np.concatenate([j, np.full(k, -1)]), pa.int32()),
             pa.array(np.concatenate([gram.ravel(), total]))],
            ["i", "j", "v"],
        )

    sums = df.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    cells = {(r.i, r.j): r.v / model.count for r in sums.collect()}  # k * (k + 1) rows
    return max(abs(cells[i, j] - cells[i, -1] * cells[j, -1] - (i == j)) for i in own for j in own)


def fit(df: DataFrame, components: int = 8) -> Model | None:
    """The model of (key, vector) rows; None if no row is left."""
    sums = cut_lineage(totals(df))
    widest = sums.filter("dim = 0").orderBy(F.desc("n"), F.desc("width")).first()
    if widest is None:
        return None
    rows = sums.filter(F.col("width") == widest.width).orderBy("dim").collect()  # a row per dimension
    exact = [int(r.s) for r in rows]
    r = corner(df, widest.n, exact)
    directions, values = solve(r, components)
    model = Model(widest.n, exact, directions, values / widest.n, float(np.sum(r * r)) / widest.n)
    model.identity_error = identity_error(df, model)
    return model


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) per usable row
    and component."""
    source = doubles(df, key, vector)
    schema = f"`{key}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(source, components)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    width, k = len(model.sums), len(model.values)
    explained = [v / model.trace if model.trace > 0.0 else None for v in model.values.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows, matrix = matrices(batch, width)
            n = len(rows)
            exact = scaled(integers(matrix), model.count, model.sums)
            w = project(exact, model).ravel()
            yield pa.RecordBatch.from_arrays(
                [keys(batch, np.repeat(rows, k)), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                 pa.array(np.full(n * k, model.count), pa.int64()),
                 pa.array(deviations(exact), pa.int64()).take(pa.array(np.repeat(np.arange(n), k))),
                 pa.array(w, mask=np.isnan(w)), pa.array(explained * n, pa.float64()),
                 pa.array([model.identity_error] * (n * k), pa.float64())],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return source.mapInArrow(run, schema)
