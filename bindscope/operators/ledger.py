"""Joins, counts and state decisions over the campaign ledger."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindscope.functions import scalars as S
from bindscope.operators import ranking as R


# ----------------------------------------------------------------------- joins
def completed_metrics(candidates: DataFrame, shards: DataFrame, critics: DataFrame) -> DataFrame:
    """Completed candidates with their shard seed and completed critic rows."""
    done = candidates.filter("status = 'completed'").select(
        "candidate_id", "shard_id", "designed_sequence", "binder_chain_id", "sequence_path", "design_metrics_json"
    )
    scored = critics.filter("status = 'completed'").drop("status")
    return done.join(shards.select("shard_id", "seed"), "shard_id").join(scored, "candidate_id")


def source_critic(critics: DataFrame) -> DataFrame:
    """Per candidate the completed critic with the smallest name, in one aggregation."""
    done = critics.filter("status = 'completed'")
    cols = [c for c in done.columns if c != "candidate_id"]
    packed = F.min_by(F.struct(*cols), "critic_name").alias("__row")
    return done.groupBy("candidate_id").agg(packed).select("candidate_id", *[F.col(f"__row.{c}").alias(c) for c in cols])


def _with_source(df: DataFrame, critics: DataFrame) -> DataFrame:
    # Only what is used: the row of a candidate is packed whole.
    held = critics.select("candidate_id", "critic_name", "status", "iptm", "structure_path")
    src = source_critic(held).select(
        "candidate_id",
        F.col("critic_name").alias("source_critic"),
        F.col("iptm").alias("critic_iptm"),
        F.col("structure_path").alias("source_structure_path"),
    )
    return df.join(src, "candidate_id", "left")


def with_verdict(tasks: DataFrame) -> DataFrame:
    """Adds ``validator_passed`` from the metrics document where the table has no such column."""
    if "validator_passed" in tasks.columns:
        return tasks
    docs = S.once(tasks, "__v", S.decode_metrics("metrics_json", "validation_id"))
    return docs.withColumn("validator_passed", F.try_element_at("__v", F.lit("validation_passed"))).drop("__v")


def with_framework(candidates: DataFrame) -> DataFrame:
    """Adds ``framework`` and ``binder_scaffold`` from the design document where the table has
    no such columns."""
    if {"framework", "binder_scaffold"} <= set(candidates.columns):
        return candidates
    docs = S.once(candidates, "__d", S.decode_metrics("design_metrics_json", "candidate_id"))
    get = lambda key: F.try_element_at("__d", F.lit(key))
    return docs.withColumn("framework", S.nonblank(get("framework"), get("framework_name"))).withColumn(
        "binder_scaffold", F.lower(F.trim(get("binder_scaffold")))
    ).drop("__d")


def task_rows(tasks: DataFrame, candidates: DataFrame, shards: DataFrame, critics: DataFrame, poses: DataFrame | None = None) -> DataFrame:
    """One report row per validation task with candidate, seed and source critic.

    ``poses`` has ``validation_id`` and ``rmsd``; without it and without a column ``rmsd`` of
    the tasks, ``rmsd`` is NULL.
    """
    tasks = with_verdict(tasks)
    if poses is not None:
        tasks = tasks.drop("rmsd").join(poses.select("validation_id", "rmsd"), "validation_id", "left")
    elif "rmsd" not in tasks.columns:
        tasks = tasks.withColumn("rmsd", F.lit(None).cast("double"))
    base = tasks.select(
        "validation_id", "candidate_id", "model_name", "validation_config_hash", "selection_rank",
        F.col("status").alias("validator_status"), "validator_passed",
        F.col("iptm").alias("validator_iptm"), F.col("ipsae").alias("validator_ipsae"),
        F.col("ranking_score").alias("validator_ranking_score"), "rmsd",
        F.col("output_structure_path").alias("validated_structure_path"),
    )
    cand = with_framework(candidates).select("candidate_id", "shard_id", "designed_sequence", "framework", "binder_scaffold")
    # Seeds first: the joins behind it then share the exchange by candidate.
    seeded = cand.join(shards.select("shard_id", "seed"), "shard_id")
    return _with_source(base.join(seeded, "candidate_id"), critics)


def structure_rows(samples: DataFrame, tasks: DataFrame, candidates: DataFrame, critics: DataFrame) -> DataFrame:
    base = samples.select(
        "validation_id", "structure_id", "candidate_id", "model_name", "seed", "sample_rank",
        F.col("status").alias("structure_status"), "structure_path",
        F.col("scoped_iptm").alias("validator_iptm"), F.col("scoped_ipsae").alias("validator_ipsae"),
        F.col("ranking_score").alias("validator_ranking_score"),
    )
    meta = tasks.select("validation_id", "validation_config_hash", "selection_rank")
    cand = candidates.select("candidate_id", "designed_sequence")
    return _with_source(base.join(meta, "validation_id").join(cand, "candidate_id"), critics)


def _open_dependencies(deps: DataFrame, jobs: DataFrame) -> DataFrame:
    waiting = jobs.filter(~F.col("status").isin("ready", "skipped")).select("msa_job_id", F.col("status").alias("job_status"))
    return deps.select("candidate_id", "msa_job_id", "validation_config_hash").join(waiting, "msa_job_id")


def ready_tasks(tasks: DataFrame, deps: DataFrame, jobs: DataFrame) -> DataFrame:
    """Pending tasks with budget left and no unfinished dependency of the same configuration."""
    pending = tasks.filter((F.col("status") == "pending") & (F.col("attempt_count") < F.col("max_attempts")))
    return pending.join(_open_dependencies(deps, jobs), ["candidate_id", "validation_config_hash"], "left_anti")


def blocked_counts(tasks: DataFrame, deps: DataFrame, jobs: DataFrame) -> DataFrame:
    pending = tasks.filter("status = 'pending'").select("validation_id", "candidate_id", "validation_config_hash")
    blocked = pending.join(_open_dependencies(deps, jobs), ["candidate_id", "validation_config_hash"])
    pairs = blocked.select("job_status", "validation_id").distinct()
    return pairs.groupBy("job_status").agg(F.count(F.lit(1)).alias("tasks"))


def job_failures(jobs: DataFrame, deps: DataFrame) -> DataFrame:
    """Failed jobs with their dependent candidates, one row per pair: a job shared by a
    large part of the campaign never becomes one row.

    Pairs come from an inner join, whose crowded side can be split at run time; jobs
    without dependents are added by an anti join.
    """
    failed = jobs.filter("status = 'failed'").select(
        "msa_job_id", "scope", F.coalesce("error_message", F.lit("")).alias("error_message"), "completed_at"
    )
    pairs = failed.join(deps.select("msa_job_id", "candidate_id"), "msa_job_id")
    lonely = failed.join(deps.select("msa_job_id").distinct(), "msa_job_id", "left_anti")
    return pairs.unionByName(lonely.withColumn("candidate_id", F.lit(None).cast("string")))


def _refs(df: DataFrame, table: str, row_id: Column, path: str, kind: str) -> DataFrame:
    return df.filter(F.col(path).isNotNull()).select(
        F.lit(kind).alias("kind"), F.col(path).alias("path"), F.lit(table).alias("table_name"), row_id.alias("row_id"), "candidate_id"
    )


def referenced_paths(candidates: DataFrame, critics: DataFrame, tasks: DataFrame, samples: DataFrame) -> DataFrame:
    parts = [
        _refs(candidates, "candidates", F.col("candidate_id"), "sequence_path", "missing_sequence_artifact"),
        _refs(critics, "critic_metrics", F.concat_ws(":", "candidate_id", "critic_name"), "structure_path", "missing_structure_artifact"),
        _refs(tasks, "validation_tasks", F.col("validation_id"), "output_structure_path", "missing_validation_artifact"),
        _refs(samples, "validation_structures", F.concat_ws(":", "validation_id", "structure_id"), "structure_path", "missing_validation_artifact"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile(
    candidates: DataFrame, critics: DataFrame, tasks: DataFrame, samples: DataFrame, inventory: DataFrame, tracked_root: str = "shards/",
    columns: Sequence[str] = ("kind", "path", "table_name", "row_id"),
) -> DataFrame:
    """Rows without files and files without rows, by one full join on the path. ``columns``
    may also name candidate_id, the candidate of the row."""
    refs = referenced_paths(candidates, critics, tasks, samples)
    both = refs.join(inventory.select("path", F.lit(True).alias("__stored")), "path", "full_outer")
    missing = F.col("__stored").isNull()
    stray = F.col("kind").isNull() & F.col("path").startswith(tracked_root)
    return both.filter(missing | stray).withColumn("kind", F.coalesce("kind", F.lit("untracked_artifact"))).select(*columns)


def resolve_alias(df: DataFrame, name: str, aliases: DataFrame) -> DataFrame:
    """Canonical framework for an alias, else the name itself."""
    dim = aliases.groupBy(F.lower("alias").alias("__alias")).agg(F.min("canonical").alias("__canonical"))
    joined = df.join(dim, F.lower(F.trim(F.col(name))) == F.col("__alias"), "left")
    return joined.withColumn("canonical", F.coalesce("__canonical", F.col(name))).drop("__alias", "__canonical")


def alias_conflicts(aliases: DataFrame) -> DataFrame:
    """Aliases that name more than one framework."""
    pairs = aliases.select(F.lower("alias").alias("alias"), "canonical").distinct()
    return pairs.groupBy("alias").agg(F.count(F.lit(1)).alias("frameworks")).filter("frameworks > 1")


def priority_lookup(
    df: DataFrame, row_id: str, request_keys: Sequence[Column], mapping: DataFrame, mapping_keys: Sequence[Column], value: str, order: str
) -> DataFrame:
    """First hit over ordered keys; within one key the last mapping row wins.

    Both sides become (priority, key) rows, so the lookup is one equi-join.
    """
    def melt(frame: DataFrame, keys: Sequence[Column], keep: list[str]) -> DataFrame:
        items = F.array(*[F.struct(F.lit(i).alias("p"), k.alias("key")) for i, k in enumerate(keys)])
        return frame.select(*keep, F.inline(items)).filter(F.col("key").isNotNull() & (F.col("key") != ""))

    held = melt(mapping, mapping_keys, [value, order]).groupBy("p", "key").agg(F.max_by(value, order).alias("__value"))
    hits = melt(df, request_keys, [row_id]).join(held, ["p", "key"])
    best = hits.groupBy(row_id).agg(F.min_by(F.struct("p", "__value"), "p").alias("__hit"))
    found = best.select(row_id, F.col("__hit.__value").alias(value), F.col("__hit.p").alias("matched_by"))
    return df.join(found, row_id, "left")


def plan_split(candidates: DataFrame, tasks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Marks every planned row ``existing`` or ``created`` by its natural key."""
    known = tasks.select(*keys).distinct().withColumn("__known", F.lit(True))
    out = candidates.join(known, list(keys), "left")
    return out.withColumn("outcome", F.when(F.col("__known"), "existing").otherwise("created")).drop("__known")


def template_available(template: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group: same chain count and equal sequences; blank template sequences match all.

    Both inputs have ``by``, ``ordinal`` and ``sequence``.
    """
    keys = [*by, "ordinal"]
    t = template.select(*keys, S.normalize_sequence("sequence").alias("__t"), F.lit(True).alias("__ht"))
    w = wanted.select(*keys, S.normalize_sequence("sequence").alias("__w"), F.lit(True).alias("__hw"))
    both = t.join(w, keys, "full_outer")
    ok = (
        F.col("__ht").isNotNull()
        & F.col("__hw").isNotNull()
        & (F.coalesce("__t", F.lit("")).isin("") | F.col("__t").eqNullSafe(F.col("__w")))
    )
    return both.groupBy(*by).agg(F.bool_and(ok).alias("available"))


# ---------------------------------------------------------------------- counts
def status_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        part = df.groupBy("status").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "status", "n")
        out = part if out is None else out.unionByName(part)
    return out


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def value_counts(df: DataFrame, col: str, default: str = "unknown") -> DataFrame:
    value = F.coalesce(F.nullif(F.col(col).cast("string"), F.lit("")), F.lit(default)).alias("value")
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n"))


def pass_rate(df: DataFrame, measured: Column, passed: Column, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count_if(measured).alias("metric_rows"),
        F.count_if(measured & passed).alias("pass_count"),
        F.try_divide(F.count_if(measured & passed), F.count_if(measured)).alias("pass_rate"),
    )


def latest_activity(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Latest first-known timestamp over all tables; each table is reduced before the union."""
    out = None
    for df, cols in tables.values():
        part = df.agg(F.max(F.coalesce(*[F.col(c) for c in cols])).alias("t"))
        out = part if out is None else out.unionByName(part)
    return out.agg(F.max("t").alias("latest_activity_at"))


def terminal_failures(counts: DataFrame) -> DataFrame:
    failed_tables = ["shards", "candidates", "critic_metrics", "validation_tasks", "validation_msa_jobs"]
    hit = ((F.col("status") == "failed") & F.col("table_name").isin(failed_tables)) | (
        (F.col("status") == "cancelled") & (F.col("table_name") == "shards")
    )
    return counts.agg(F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("terminal_failures"))


def lifecycle_blockers(counts: DataFrame) -> DataFrame:
    """Text of every pending, running or failed count of validation tasks and jobs."""
    tables = {"validation_tasks": 0, "validation_msa_jobs": 1}
    states = {"pending": 0, "running": 1, "failed": 2}
    rank = F.lit(None).cast("int")
    for t, a in tables.items():
        for s, b in states.items():
            rank = F.when((F.col("table_name") == t) & (F.col("status") == s), a * 3 + b).otherwise(rank)
    text = F.concat(F.col("table_name"), F.lit(" "), F.col("status"), F.lit("="), F.col("n").cast("string"))
    ranked = counts.select(rank.alias("r"), text.alias("t"), "n").filter("r is not null and n > 0")
    listed = ranked.agg(F.array_sort(F.collect_list(F.struct("r", "t"))).alias("items"))
    joined = F.array_join(F.transform("items", lambda x: x["t"]), "; ")
    return listed.select(F.nullif(joined, F.lit("")).alias("blockers"))


def config_variants(tasks: DataFrame) -> DataFrame:
    """Tasks whose (candidate, model) has several configurations need a file suffix."""
    pairs = tasks.select("candidate_id", "model_name", "validation_config_hash").distinct()
    n = pairs.groupBy("candidate_id", "model_name").agg(F.count(F.lit(1)).alias("config_count"))
    return tasks.select("validation_id", "candidate_id", "model_name").join(n, ["candidate_id", "model_name"]).select(
        "validation_id", "config_count", (F.col("config_count") > 1).alias("needs_suffix")
    )


def worker_completions(attempts: DataFrame, stage: str) -> DataFrame:
    done = attempts.filter((F.col("stage") == stage) & (F.col("status") == "completed"))
    return done.groupBy("worker_id").agg(F.count(F.lit(1)).alias("completed"))


def validation_summary(tasks: DataFrame, samples: DataFrame, issues: DataFrame) -> DataFrame:
    status, passed = F.col("status"), S.opt_bool("validator_passed")
    path_pass = F.instr(F.concat(F.lit("/"), F.coalesce("output_structure_path", F.lit(""))), "/passing/") > 0
    t = with_verdict(tasks).agg(
        F.count(F.lit(1)).alias("planned_validation_count"),
        *[F.count_if(status == s).alias(f"{s}_count") for s in ("completed", "failed", "skipped", "pending", "running")],
        F.count_if((status == "completed") & F.coalesce(passed, path_pass)).alias("completed_task_pass_count"),
    )
    s = samples.agg(
        F.count_if(status == "passing").alias("passing_structure_count"),
        F.count_if(status == "rejected").alias("rejected_structure_count"),
    )
    i = issues.agg(
        F.count(F.lit(1)).alias("issues"),
        F.count_if(F.col("kind").startswith("missing_")).alias("missing_artifacts"),
        F.count_if(F.col("kind").startswith("missing_validation")).alias("missing_validation_artifacts"),
        F.count_if(F.col("kind") == "untracked_artifact").alias("untracked_artifacts"),
    )
    return t.select("*", *[s.select(c).scalar().alias(c) for c in s.columns], *[i.select(c).scalar().alias(c) for c in i.columns])


def pose_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("rmsd").alias("rows_with_binder_ca_rmsd"),
        (F.count(F.lit(1)) - F.count("rmsd")).alias("rows_missing_binder_ca_rmsd"),
    )


def error_histogram(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & (F.col(col) != "")).groupBy(F.col(col).alias("error")).agg(F.count(F.lit(1)).alias("n"))


def next_batch(ready: DataFrame, n: int) -> DataFrame:
    keys = [F.col("selection_rank").asc_nulls_last(), F.col("validation_id").asc()]
    return ready.orderBy(*keys).limit(n)
