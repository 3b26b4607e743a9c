"""Insert-if-absent, upserts and key migration as whole-table transformations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_new(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(rows.select(*target.columns).join(target.select(*keys), list(keys), "left_anti"))


def upsert(target: DataFrame, rows: DataFrame, keys: Sequence[str], rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Full outer join on the keys; a matching row takes every incoming value except where
    ``rules`` gives an expression over ``old``, ``new`` (structs) for a column."""
    rules = rules or {}
    cols = target.columns
    old = target.select(*keys, F.struct(*cols).alias("old"))
    new = rows.select(*keys, F.struct(*[c for c in cols if c in rows.columns]).alias("new"))
    both = old.join(new, list(keys), "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in rules:
            out.append(rules[c].alias(c))
        elif c in rows.columns:
            out.append(F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c))
        else:
            out.append(F.col(f"old.{c}").alias(c))
    return both.select(*out)


def _keep_old(c: str) -> Column:
    return F.coalesce(F.col(f"old.{c}"), F.col(f"new.{c}"))


def upsert_candidates(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Clears the error of a rewritten row and keeps its index and start time."""
    rules = {
        "candidate_index": _keep_old("candidate_index"), "started_at": _keep_old("started_at"),
        "error_message": F.when(F.col("new").isNull(), F.col("old.error_message")),
    }
    return upsert(target, rows, ["candidate_id"], rules)


def upsert_critics(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``attempt_count`` is the old count plus one, or 1 for a first row."""
    count = F.when(F.col("new").isNull(), F.col("old.attempt_count")).otherwise(
        F.coalesce(F.col("old.attempt_count") + 1, F.lit(1).cast("bigint"))
    )
    rules = {"attempt_count": count, "started_at": _keep_old("started_at"), "error_message": F.when(F.col("new").isNull(), F.col("old.error_message"))}
    rules = {k: v for k, v in rules.items() if k in target.columns}
    return upsert(target, rows, ["candidate_id", "critic_name"], rules)


def upsert_samples(target: DataFrame, rows: DataFrame, doc: str, derived: Mapping[str, Sequence[str]]) -> DataFrame:
    """Scalar columns come from the JSON document by key priority."""
    parsed = rows.withColumn("__doc", F.from_json(F.col(doc), "map<string,string>"))
    for col, names in derived.items():
        values = [F.try_element_at("__doc", F.lit(n)).try_cast("double") for n in names]
        parsed = parsed.withColumn(col, F.coalesce(*values))
    return upsert(target, parsed.drop("__doc"), ["validation_id", "structure_id"])


def migrate_dependencies(deps: DataFrame, order: str) -> DataFrame:
    """Widen the key by an empty configuration hash; the first row of a key wins."""
    widened = deps.withColumn("validation_config_hash", F.lit(""))
    keys = ["candidate_id", "msa_job_id", "validation_config_hash"]
    cols = [c for c in widened.columns if c not in keys]
    best = widened.groupBy(*keys).agg(F.min_by(F.struct(*cols), order).alias("r"))
    return best.select(*keys, *[F.col(f"r.{c}").alias(c) for c in cols])


def config_conflicts(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Campaigns whose incoming configuration hash differs from the stored one."""
    old = existing.select("campaign_id", F.col("config_hash").alias("stored_hash"))
    return incoming.select("campaign_id", "config_hash").join(old, "campaign_id").filter("config_hash <> stored_hash")


def check_config_hash(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows, failing on the first campaign planned with another configuration."""
    old = existing.select("campaign_id", F.col("config_hash").alias("__stored"))
    joined = incoming.join(old, "campaign_id", "left")
    bad = F.col("__stored").isNotNull() & (F.col("__stored") != F.col("config_hash"))
    text = F.concat(F.lit("configuration differs for campaign "), F.col("campaign_id").cast("string"))
    return joined.withColumn("config_hash", F.when(bad, F.raise_error(text).cast("string")).otherwise(F.col("config_hash"))).drop("__stored")
