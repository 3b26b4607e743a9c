"""Ordering, ranking, de-duplication and top-k without a single-task global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Sort keys are plain ascending expressions, so they can be compared as one struct.
def high_first(c: Column | str) -> Column:
    """Larger values first, missing last."""
    return F.coalesce(-_col(c).cast("double"), F.lit(INF))


def low_first(c: Column | str) -> Column:
    """Smaller values first, missing last."""
    return F.coalesce(_col(c).cast("double"), F.lit(INF))


def int_first(c: Column | str, missing: int = 10**9) -> Column:
    """Ascending integers; missing and zero share the place of ``missing``."""
    return F.coalesce(F.nullif(_col(c).cast("bigint"), F.lit(0).cast("bigint")), F.lit(missing).cast("bigint"))


def text_first(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def true_first(c: Column) -> Column:
    return F.when(c, 0).otherwise(1)


def status_order(c: Column | str) -> Column:
    """completed, running, pending, skipped, failed, then anything else."""
    order = ["completed", "running", "pending", "skipped", "failed"]
    out = F.when(_col(c) == order[0], 0)
    for i, name in enumerate(order[1:], start=1):
        out = out.when(_col(c) == name, i)
    return out.otherwise(5)


def best_per_group(df: DataFrame, by: Sequence[str], keys: Sequence[Column]) -> DataFrame:
    """First row of every group. The rank limit is applied before the shuffle as well,
    so a hot group sends one row per task."""
    w = Window.partitionBy(*by).orderBy(*keys)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def dedup_best(df: DataFrame, key: str, keys: Sequence[Column]) -> DataFrame:
    return best_per_group(df, [key], keys)


def top_n(df: DataFrame, keys: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows; only those ``n`` rows reach the numbering step."""
    if n <= 0:
        raise ValueError("n must be positive")
    head = df.orderBy(*keys).limit(n)
    if rank is None:
        return head
    return head.withColumn(rank, F.row_number().over(Window.orderBy(*keys)).cast("bigint"))


def group_text(c: Column | str) -> Column:
    """Text of a group value, never null, different for null and empty text."""
    text = _col(c).cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.lit("="), text))


def _touch(df: DataFrame) -> Column:
    """A hash that reads every column, so that a plan over ``df`` can't drop one."""
    def plain(name: str, kind: T.DataType) -> Column:
        return F.map_entries(F.col(f"`{name}`")) if isinstance(kind, T.MapType) else F.col(f"`{name}`")

    return F.hash(*[plain(f.name, f.dataType) for f in df.schema.fields])


def _splitters(points: DataFrame, n: int) -> Column:
    """``n - 1`` increasing points from a bounded bottom-k hash sample of ``__point``."""
    sample = points.select("__point", F.xxhash64("__point").alias("__h")).orderBy("__h").limit(32 * n)
    ordered = sample.agg(F.array_sort(F.collect_list("__point")).alias("s"))
    return ordered.select(
        F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get(F.col("s"), (i * F.size("s") / n).cast("int")))
    ).scalar()


def add_rank(
    df: DataFrame, keys: Sequence[Column], rank: str, by: Sequence[str] = (), buckets: int | None = None,
    columns: Sequence[str] | None = None, sample: DataFrame | None = None,
) -> DataFrame:
    """Exact ``row_number`` within groups of any number and size, with one exchange of the rows.

    Rows are dealt to ordered buckets along (group, sort key), cut by splitters from a
    bounded sample. A bucket sends one summary row: its first group, its last group and how
    many rows that has. A rank is the place in the bucket; only a bucket's first group can
    have begun before it, so one number per bucket, the rows of that group in earlier
    buckets, completes it. The summary reads the exchange that the ranking reads: it names
    all columns, so that both are the same plan and Spark runs it once. Name the ``columns``
    to return if they are fewer than all: a later projection would make the plans differ.
    Splitters come from ``sample``, by default the rows themselves; name a cheaper frame of
    like rows where ``df`` is costly to read twice. No task sees a whole group unless it fits a
    bucket. ``keys`` must end in a unique tie-break.
    """
    names = df.columns if columns is None else list(columns)
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.concat_ws("\x1f", F.lit(""), *[group_text(c) for c in by])
    point = F.struct(group.alias("g"), *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    keyed = df.select(*[F.col(f"`{c}`") for c in names], point.alias("__point"))
    slot = F.lit(0)
    if n > 1:
        keyed = keyed.withColumn("__splits", _splitters((df if sample is None else sample).select(point.alias("__point")), n))
        for step in (1 << b for b in reversed(range((n - 1).bit_length()))):
            keyed = keyed.withColumn("__slot", slot)
            slot = F.col("__slot") + F.when(F.get("__splits", F.col("__slot") + (step - 1)) <= F.col("__point"), step).otherwise(0)
    dealt = keyed.withColumn("__slot", slot).drop("__splits").repartition(n, "__slot")
    counts = dealt.withColumn("__g", F.col("__point.g")).groupBy("__slot", "__g").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(_touch(dealt)).alias("__all")
    )
    ends = counts.groupBy("__slot").agg(
        F.min("__g").alias("first"), F.max(F.struct("__g", "n")).alias("last"), F.bit_xor("__all").alias("__all")
    )
    # Two rows a bucket: what its last group has, and what its first group asks for.
    marks = ends.select("__slot", F.explode(F.array(
        F.struct(F.col("first").alias("g"), F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("asks"), F.col("__all").alias("x")),
        F.struct(F.col("last.__g").alias("g"), F.col("last.n").alias("n"), F.lit(False).alias("asks"), F.col("__all").alias("x")),
    )).alias("m")).select("__slot", "m.*")
    earlier = Window.partitionBy("g").orderBy("__slot", F.desc("asks")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = marks.withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0))).filter("asks").select(
        F.col("__slot").alias("__s"), F.col("g").alias("__first"), "ahead"
    )
    inside = Window.partitionBy("__slot", F.col("__point.g")).orderBy("__point")
    placed = dealt.withColumn("__rn", F.row_number().over(inside))
    # At most one row per bucket: the bound that lets it be broadcast.
    joined = placed.join(F.broadcast(ahead), F.col("__slot") == F.col("__s"))
    before = F.when(F.col("__point.g") == F.col("__first"), F.col("ahead")).otherwise(0)
    return joined.select(*[F.col(f"`{c}`") for c in names], (F.col("__rn") + before).cast("bigint").alias(rank))
