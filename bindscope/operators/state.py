"""Retry, stale and reopen rules as table transformations over many campaigns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLAIM = ("claim_worker_id", "claim_pid", "heartbeat_at")


def _release(df: DataFrame, hit: Column, now: Column, error: Column) -> DataFrame:
    """Rows marked ``hit`` go back to pending while budget is left, else they fail."""
    out = df.withColumn("__hit", hit).withColumn(
        "__next", F.when(F.col("attempt_count") < F.col("max_attempts"), "pending").otherwise("failed")
    )
    failed = F.col("__hit") & (F.col("__next") == "failed")
    for c in CLAIM:
        if c in df.columns:
            out = out.withColumn(c, F.when(~F.col("__hit"), F.col(c)))
    if "completed_at" in df.columns:
        out = out.withColumn("completed_at", F.when(failed, now).otherwise(F.col("completed_at")))
    if "error_message" in df.columns:
        out = out.withColumn("error_message", F.when(failed, error).when(~F.col("__hit"), F.col("error_message")))
    return out.withColumn("status", F.when(F.col("__hit"), F.col("__next")).otherwise(F.col("status"))).drop("__next")


def apply_failures(tasks: DataFrame, failures: DataFrame, key: str, now: Column, retry_after: Column | None = None) -> DataFrame:
    """Record failures: one ``failed_message`` per task key. Jobs may wait ``retry_after`` seconds."""
    marks = failures.select(key, F.col("failed_message").alias("__message"))
    joined = tasks.join(marks, key, "left")
    out = _release(joined, F.col("__message").isNotNull(), now, F.col("__message"))
    if retry_after is not None and "next_eligible_at" in tasks.columns:
        later = now + F.make_dt_interval(secs=retry_after)
        out = out.withColumn("next_eligible_at", F.when(F.col("__hit"), later).otherwise(F.col("next_eligible_at")))
    return out.select(*tasks.columns)


def sweep_stale(tasks: DataFrame, cutoff: Column, now: Column, message: str = "stale claim") -> DataFrame:
    """Running rows whose heartbeat is older than the cutoff; no heartbeat is never stale."""
    stale = F.coalesce((F.col("status") == "running") & (F.col("heartbeat_at") < cutoff), F.lit(False))
    return _release(tasks, stale, now, F.lit(message)).withColumnRenamed("__hit", "swept")


def sweep_workers(tasks: DataFrame, dead: DataFrame, now: Column, message: str = "worker exited") -> DataFrame:
    """Running rows claimed by a dead worker; a NULL pid in ``dead`` matches any pid."""
    gone = dead.select(F.col("worker_id").alias("__w"), F.col("pid").alias("__p")).distinct()
    anyone = gone.filter("__p is null").select("__w").withColumn("__any", F.lit(True))
    exact = gone.filter("__p is not null").withColumn("__one", F.lit(True))
    joined = tasks.join(anyone, tasks["claim_worker_id"] == anyone["__w"], "left").drop("__w")
    joined = joined.join(exact, (joined["claim_worker_id"] == exact["__w"]) & (joined["claim_pid"] == exact["__p"]), "left")
    hit = (F.col("status") == "running") & (F.coalesce("__any", F.lit(False)) | F.coalesce("__one", F.lit(False)))
    out = _release(joined, hit, now, F.lit(message))
    return out.select(*tasks.columns, F.col("__hit").alias("swept"))


def close_attempts(attempts: DataFrame, swept: DataFrame, key: str, now: Column, message: str) -> DataFrame:
    """Running attempts of swept rows become ``stale``."""
    marks = swept.select(key).distinct().withColumn("__stale", F.lit(True))
    out = attempts.join(marks, key, "left")
    hit = F.coalesce("__stale", F.lit(False)) & (F.col("status") == "running")
    out = out.withColumn("__hit", hit)
    cols = {"status": F.when(F.col("__hit"), "stale").otherwise(F.col("status")), "ended_at": F.when(F.col("__hit"), now).otherwise(F.col("ended_at"))}
    if "error_message" in attempts.columns:
        cols["error_message"] = F.when(F.col("__hit"), F.coalesce("error_message", F.lit(message))).otherwise(F.col("error_message"))
    for name, value in cols.items():
        out = out.withColumn(name, value)
    return out.select(*attempts.columns)


# Cache entries a ready job must still have.
REQUIRED_CACHE_KEYS = ("non_pairing_path", "metadata_path")


def missing_cache(jobs: DataFrame, inventory: DataFrame) -> DataFrame:
    """First missing required file per ready job; keys are found at any JSON depth."""
    pattern = '"(?:' + "|".join(REQUIRED_CACHE_KEYS) + r')"\s*:\s*"\s*([^"]*?)\s*"'
    ready = jobs.filter("status = 'ready'")
    paths = ready.select("msa_job_id", F.posexplode(F.regexp_extract_all("cache_paths_json", F.lit(pattern), F.lit(1))).alias("ordinal", "path"))
    gone = paths.filter("path <> ''").join(inventory.select("path"), "path", "left_anti")
    return gone.groupBy("msa_job_id").agg(F.min_by("path", "ordinal").alias("missing_path"))


def reopen_missing(jobs: DataFrame, inventory: DataFrame) -> DataFrame:
    """Ready jobs whose required cache files vanished are pending again, budget restored."""
    out = jobs.join(missing_cache(jobs, inventory), "msa_job_id", "left").withColumn("__hit", F.col("missing_path").isNotNull())
    for c in (*CLAIM, "completed_at", "next_eligible_at"):
        if c in jobs.columns:
            out = out.withColumn(c, F.when(~F.col("__hit"), F.col(c)))
    text = F.concat(F.lit("ready MSA cache artifact missing: "), "missing_path")
    return (
        out.withColumn("error_message", F.when(F.col("__hit"), text).otherwise(F.col("error_message")))
        .withColumn("attempt_count", F.when(F.col("__hit"), F.lit(0).cast("bigint")).otherwise(F.col("attempt_count")))
        .withColumn("status", F.when(F.col("__hit"), "pending").otherwise(F.col("status")))
        .select(*jobs.columns)
    )


def retry_failed(jobs: DataFrame, deps: DataFrame, job_ids: DataFrame | None = None, candidate_ids: DataFrame | None = None, reset: bool = True) -> DataFrame:
    """Failed jobs named by id and/or by dependent candidate; both filters are AND-ed."""
    chosen = jobs.filter("status = 'failed'").select("msa_job_id")
    if job_ids is not None:
        chosen = chosen.join(job_ids.select("msa_job_id"), "msa_job_id", "left_semi")
    if candidate_ids is not None:
        named = deps.join(candidate_ids.select("candidate_id"), "candidate_id", "left_semi").select("msa_job_id")
        chosen = chosen.join(named, "msa_job_id", "left_semi")
    out = jobs.join(chosen.withColumn("__hit", F.lit(True)), "msa_job_id", "left").withColumn("__hit", F.coalesce("__hit", F.lit(False)))
    for c in (*CLAIM, "completed_at", "next_eligible_at", "error_message"):
        if c in jobs.columns:
            out = out.withColumn(c, F.when(~F.col("__hit"), F.col(c)))
    if reset:
        out = out.withColumn("attempt_count", F.when(F.col("__hit"), F.lit(0).cast("bigint")).otherwise(F.col("attempt_count")))
    return out.withColumn("status", F.when(F.col("__hit"), "pending").otherwise(F.col("status"))).select(*jobs.columns)


def check_completion(tasks: DataFrame, samples: DataFrame) -> DataFrame:
    """Completed tasks whose chosen structure is not recorded, judged and measured."""
    doc = F.from_json("metrics_json", "map<string,string>")
    good = samples.filter(F.col("status").isin("passing", "rejected") & (F.coalesce(F.size(doc), F.lit(0)) > 0))
    held = good.select("validation_id", F.col("structure_path").alias("output_structure_path"))
    done = tasks.filter("status = 'completed'").select("validation_id", "output_structure_path")
    return done.join(held, ["validation_id", "output_structure_path"], "left_anti")

