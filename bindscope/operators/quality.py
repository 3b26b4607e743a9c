"""Constraint checks that return the violating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Allowed states per table.
STATUS_DOMAINS = {
    "shards": ("pending", "running", "completed", "failed", "cancelled"),
    "candidates": ("pending", "running", "completed", "failed", "skipped"),
    "critic_metrics": ("pending", "running", "completed", "failed", "skipped"),
    "validation_tasks": ("pending", "running", "completed", "failed", "skipped"),
    "validation_structures": ("pending", "passing", "rejected"),
    "validation_msa_jobs": ("pending", "running", "ready", "failed", "skipped"),
    "attempts": ("running", "completed", "failed", "stale", "cancelled"),
}


def expectations(df: DataFrame, row_id: Column, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking a rule, one output row per rule broken; one scan for all rules.

    Like a SQL CHECK, a rule that evaluates to NULL is not broken.
    """
    broken = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]))
    return df.select(row_id.alias("row_id"), F.explode(broken).alias("rule"))


def domain_rule(table: str) -> dict[str, Column]:
    """The status rule of a ledger table, from its declared domain."""
    return {"status": F.col("status").isin(*STATUS_DOMAINS[table])}


def audit(tables: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """(table_name, rule, checked, broken) of all row rules, each table read once. A rule that
    evaluates to NULL is not broken."""
    parts = []
    for name, (df, rules) in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("checked"), *[F.count_if(~rule).alias(f"r{k}") for k, rule in enumerate(rules.values())])
        said = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"r{k}").alias("broken")) for k, rule in enumerate(rules)])
        parts.append(counts.select(F.lit(name).alias("table_name"), "checked", F.inline(said)))
    return reduce(DataFrame.unionByName, parts).select("table_name", "rule", "checked", "broken")


def violations(tables: Mapping[str, tuple[DataFrame, Mapping[str, Column]]], row_ids: Mapping[str, Column]) -> DataFrame:
    """(table_name, row_id, rule) of every broken rule. The audit's counts, one row per rule,
    decide which tables are read again and for which rules."""
    broken: dict[str, list[str]] = {}
    for r in audit(tables).filter("broken > 0").collect():
        broken.setdefault(r.table_name, []).append(r.rule)
    parts = [
        expectations(tables[t][0], row_ids[t].cast("string"), {k: v for k, v in tables[t][1].items() if k in rules}).select(F.lit(t).alias("table_name"), "row_id", "rule")
        for t, rules in broken.items()
    ]
    if not parts:
        some = next(iter(tables.values()))[0]
        return some.limit(0).select(F.lit("").alias("table_name"), F.lit("").alias("row_id"), F.lit("").alias("rule"))
    return reduce(DataFrame.unionByName, parts)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def check_foreign_key(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return child.filter(present).join(parent.select(*keys), list(keys), "left_anti")


def check_ranges(ranges: DataFrame, by: Sequence[str], order: str, length: str) -> DataFrame:
    """1-based inclusive ranges: positive, ordered, in bounds, not overlapping."""
    w = Window.partitionBy(*by).orderBy(order)
    prev_start, prev_end = F.lag("start").over(w), F.lag("end").over(w)
    furthest = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = ranges.withColumn("__ps", prev_start).withColumn("__pe", prev_end).withColumn("__far", furthest)
    rule = (
        F.when((F.col("start") <= 0) | (F.col("end") <= 0), "positions must be positive")
        .when(F.col("end") < F.col("start"), "end must be >= start")
        .when(F.col("end") > F.col(length), "end is outside the sequence")
        .when(F.col("start") < F.col("__ps"), "ranges must appear in sequence order")
        .when(F.col("start") <= F.col("__far"), "range overlaps an earlier one")
    )
    return marked.withColumn("rule", rule).filter("rule is not null").drop("__ps", "__pe", "__far")


def check_contiguous(residues: DataFrame, by: Sequence[str], order: str, number: str, full: str | None = None) -> DataFrame:
    """Gaps in observed numbering. A step of 0 (insertion codes) or 1 is legal; chains with
    a non-numeric id, or with a full sequence, are not checked."""
    n = F.col(number).try_cast("bigint")
    chain = Window.partitionBy(*by)
    w = chain.orderBy(order)
    marked = residues.withColumn("__n", n).withColumn("__text", F.max(F.col("__n").isNull()).over(chain))
    if full is not None:
        marked = marked.filter(~F.coalesce(F.col(full), F.lit(False)))
    marked = marked.withColumn("next_number", F.lead("__n").over(w))
    gap = ~F.col("__text") & ~(F.col("next_number") - F.col("__n")).isin(0, 1)
    return marked.filter(gap).select(*by, F.col("__n").alias("number"), "next_number")


def check_hotspots_resolved(residues: DataFrame, hotspots: DataFrame, keys: Sequence[str]) -> DataFrame:
    resolved = residues.filter("x is not null").select(*keys)
    return hotspots.join(resolved, list(keys), "left_anti")


def check_pair_mask(pairs: DataFrame, spans: DataFrame, by: str = "structure_id") -> DataFrame:
    """Mismatch counts between a pair mask and the block mask implied by chain spans.

    ``spans`` has chain, start, end per structure; the expected mask is true inside each
    chain's block. Every pair meets the spans of its structure as one row, bounded by its chains.
    """
    blocks = spans.groupBy(by).agg(F.collect_list(F.struct("start", "end")).alias("__blocks"))
    within = lambda s: (F.col("i") >= s["start"]) & (F.col("i") < s["end"]) & (F.col("j") >= s["start"]) & (F.col("j") < s["end"])
    marked = pairs.join(blocks, by, "left")
    expected = F.coalesce(F.exists("__blocks", within), F.lit(False))
    wanted = spans.groupBy(by).agg(F.sum((F.col("end") - F.col("start")) * (F.col("end") - F.col("start"))).alias("expected_pairs"))
    agg = marked.groupBy(by).agg(
        F.count_if(F.col("mask") & ~expected).alias("unexpected_pairs"), F.count_if(~F.col("mask") & expected).alias("masked_out_pairs"),
        F.count_if(expected).alias("covered_pairs"),
    )
    out = wanted.join(agg, by, "full_outer").na.fill(0)
    return out.withColumn("absent_pairs", F.col("expected_pairs") - F.col("covered_pairs"))
