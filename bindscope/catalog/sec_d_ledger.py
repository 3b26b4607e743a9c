"""Counts, rates and state over the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.catalog.fragments import METRICS, PASSED, SCORED, TASKS, completed, metric_rows, scored_rows, task_rows
from bindscope.catalog.sec_c import REFS
from bindscope.operators import campaign as C
from bindscope.operators import gating as G
from bindscope.operators import ledger as L
from bindscope.operators import selection as X

_STATUS_TABLES = {
    "shards": "v_shards", "candidates": "v_candidates", "critic_metrics": "v_critic", "validation_tasks": "v_tasks",
    "validation_structures": "v_samples", "validation_msa_jobs": "v_jobs", "attempts": "v_attempts",
}
COUNTS = "counts AS (" + " UNION ALL ".join(
    f"SELECT '{k}' AS table_name, status, count(*) AS n FROM {v} GROUP BY status" for k, v in _STATUS_TABLES.items()
) + ")"


def tables(c):
    return {k: getattr(c, v) for k, v in _STATUS_TABLES.items()}


@query("d1_status_counts", f"WITH {COUNTS} SELECT * FROM counts")
def d1(c):
    return L.status_counts(tables(c))


@query("d2_table_counts", " UNION ALL ".join(f"SELECT '{k}' AS table_name, count(*) AS n FROM {v}" for k, v in _STATUS_TABLES.items()))
def d2(c):
    return L.table_counts(tables(c))


@query("d3_value_histogram", "SELECT coalesce(framework, 'unknown') AS value, count(*) AS n FROM v_candidates GROUP BY 1")
def d3(c):
    return L.value_counts(c.v_candidates, "framework")


@query(
    "d4_pass_rate",
    """SELECT count(*) FILTER (hotspot_distance_angstrom IS NOT NULL) AS metric_rows,
       count(*) FILTER (hotspot_distance_angstrom <= hotspot_cutoff) AS pass_count,
       count(*) FILTER (hotspot_distance_angstrom <= hotspot_cutoff) / count(*) FILTER (hotspot_distance_angstrom IS NOT NULL) AS pass_rate FROM v_critic""",
)
def d4(c):
    return L.pass_rate(c.v_critic, F.col("hotspot_distance_angstrom").isNotNull(), G.has_hotspot_contact())


@query(
    "d5_latest_activity",
    """SELECT strftime(max(t), '%Y-%m-%dT%H:%M:%S.%gZ') AS latest_activity_at FROM (
       SELECT max(coalesce(completed_at, heartbeat_at, started_at, created_at)) AS t FROM v_shards
       UNION ALL SELECT max(coalesce(completed_at, created_at)) FROM v_candidates UNION ALL SELECT max(started_at) FROM v_critic
       UNION ALL SELECT max(coalesce(completed_at, heartbeat_at, created_at)) FROM v_tasks UNION ALL SELECT max(created_at) FROM v_samples
       UNION ALL SELECT max(coalesce(completed_at, heartbeat_at, created_at)) FROM v_jobs
       UNION ALL SELECT max(coalesce(ended_at, started_at)) FROM v_attempts)""",
)
def d5(c):
    from bindscope.functions.scalars import format_utc

    out = L.latest_activity({
        "shards": (c.v_shards, ["completed_at", "heartbeat_at", "started_at", "created_at"]),
        "candidates": (c.v_candidates, ["completed_at", "created_at"]),
        "critic_metrics": (c.v_critic, ["started_at"]),
        "validation_tasks": (c.v_tasks, ["completed_at", "heartbeat_at", "created_at"]),
        "validation_structures": (c.v_samples, ["created_at"]),
        "validation_msa_jobs": (c.v_jobs, ["completed_at", "heartbeat_at", "created_at"]),
        "attempts": (c.v_attempts, ["ended_at", "started_at"]),
    })
    return out.select(format_utc("latest_activity_at").alias("latest_activity_at"))


@query(
    "d6_terminal_failures",
    f"""WITH {COUNTS} SELECT cast(sum(n) AS bigint) AS terminal_failures FROM counts
        WHERE (status = 'failed' AND table_name NOT IN ('attempts', 'validation_structures')) OR (status = 'cancelled' AND table_name = 'shards')""",
)
def d6(c):
    return L.terminal_failures(L.status_counts(tables(c)))


_COPIED = "EXISTS (SELECT 1 FROM v_inventory i WHERE i.path = validated_structure_path)"
_ERROR = "CASE WHEN rmsd IS NULL THEN CASE WHEN length(candidate_id) % 2 = 0 THEN 'could not match target chains' ELSE 'insufficient matched target CA atoms' END END"


@query("d10_analysis_report", f"""WITH {SCORED}, e AS (SELECT *, {_COPIED} AS copied, {_ERROR} AS pose_error FROM sc),
    m AS (SELECT framework, string_agg(model_name || '=' || n, ';' ORDER BY model_name) AS models FROM (SELECT framework, model_name, count(*) AS n FROM e GROUP BY 1, 2) GROUP BY 1),
    r AS (SELECT framework, string_agg(pose_error || '=' || n, ';' ORDER BY pose_error) AS errors FROM (SELECT framework, pose_error, count(*) AS n FROM e WHERE pose_error IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
    SELECT e.framework, count(*) FILTER (ranking_eligible) AS ranked_designs, count(*) AS diagnostic_rows, count(*) FILTER (validator_passed = 'true') AS validator_pass_count,
    count(*) FILTER (NOT ranking_eligible) AS ranking_ineligible_count, count(*) FILTER (copied AND ranking_eligible) AS copied_designs, count(rmsd) AS rows_with_binder_ca_rmsd,
    cast(84 AS bigint) AS top_k, any_value(models) AS models, any_value(errors) AS errors
    FROM e LEFT JOIN m ON m.framework IS NOT DISTINCT FROM e.framework LEFT JOIN r ON r.framework IS NOT DISTINCT FROM e.framework WHERE e.framework IS NOT NULL GROUP BY 1""")
def d10r(c):
    rows = scored_rows(c).withColumn("pose_error", F.expr(_ERROR)).filter("framework is not null")
    # A flag of the rows: they are worked out once.
    copied = c.v_inventory.filter(F.col("path") == F.col("validated_structure_path").outer()).exists()
    out = X.analysis_report(rows.withColumn("copied", copied), F.col("copied"), 84, ["framework"])
    text = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")
    return out.select(
        "framework", "ranked_designs", "diagnostic_rows", "validator_pass_count", "ranking_ineligible_count", "copied_designs", "rows_with_binder_ca_rmsd", "top_k",
        text("validator_models").alias("models"), text("pose_errors").alias("errors"),
    )


@query("d12_error_histogram", f"""WITH {SCORED} SELECT pose_error AS error, count(*) AS n FROM (SELECT {_ERROR} AS pose_error FROM sc) WHERE pose_error IS NOT NULL GROUP BY 1""")
def d12e(c):
    return L.error_histogram(task_rows(c).withColumn("pose_error", F.expr(_ERROR)), "pose_error")


def _facts_sql(shards: str, shard: str, metrics: str = "") -> str:
    """Tagged union of status rows, issues and artifacts; ``shard`` names a candidate's shard."""
    return f"""sh AS (SELECT shard_id, campaign_id, status FROM {shards}),
    ow AS (SELECT candidate_id, campaign_id, c.status FROM v_candidates c JOIN sh ON sh.shard_id = {shard}),
    facts AS (SELECT campaign_id, 'shards' AS tag, status AS value FROM sh UNION ALL SELECT campaign_id, 'candidates', status FROM ow
      UNION ALL SELECT campaign_id, 'critic_metrics', x.status FROM v_critic x JOIN ow USING (candidate_id)
      UNION ALL SELECT campaign_id, 'validation_tasks', x.status FROM v_tasks x JOIN ow USING (candidate_id)
      UNION ALL SELECT campaign_id, 'validation_structures', x.status FROM v_samples x JOIN ow USING (candidate_id)
      UNION ALL SELECT campaign_id, 'validation_msa_jobs', j.status FROM (SELECT DISTINCT campaign_id, msa_job_id FROM v_deps JOIN ow USING (candidate_id)) JOIN v_jobs j USING (msa_job_id)
      UNION ALL SELECT campaign_id, 'issues', kind FROM issues JOIN ow ON ow.candidate_id = CASE table_name WHEN 'candidates' THEN row_id
        WHEN 'critic_metrics' THEN split_part(row_id, ':', 1) ELSE 'cand_' || split_part(row_id, '_', 2) END
      {metrics})"""


_STATES = f"""WITH {REFS}, {_facts_sql("v_campaign_shards", "'one_' || c.candidate_index", """UNION ALL SELECT cast(regexp_extract(path, '(\\d+)', 1) AS bigint), 'issues', kind FROM issues WHERE table_name IS NULL
        UNION ALL SELECT campaign_id, 'artifacts', name FROM v_artifacts""")},
    a AS (SELECT campaign_id,
      count(*) FILTER ((tag IN ('shards', 'candidates', 'critic_metrics', 'validation_tasks', 'validation_msa_jobs') AND value = 'failed') OR (tag = 'shards' AND value = 'cancelled')) AS failed,
      count(*) FILTER (tag NOT IN ('issues', 'artifacts') AND value = 'running') AS running, count(*) FILTER (tag NOT IN ('issues', 'artifacts') AND value = 'pending') AS pending,
      count(*) FILTER (tag = 'issues') AS issues, count(*) FILTER (tag = 'shards') AS shards, count(*) FILTER (tag = 'shards' AND value = 'completed') AS shards_done,
      count(*) FILTER (tag = 'artifacts' AND value LIKE 'critic%') AS designed, count(*) FILTER (tag = 'artifacts' AND value NOT LIKE 'critic%') AS validated
      FROM facts GROUP BY 1),
    b AS (SELECT c.*, coalesce(failed, 0) AS failed, coalesce(running, 0) AS running, coalesce(pending, 0) AS pending, coalesce(issues, 0) AS issues,
      coalesce(shards, 0) AS shards, coalesce(shards_done, 0) AS shards_done, CASE WHEN validation_configured THEN validated = 3 ELSE designed = 2 END AS ready
      FROM v_campaigns c LEFT JOIN a USING (campaign_id))
    SELECT campaign_id, failed, running, pending, issues, shards, shards_done, CASE WHEN failed > 0 THEN 'failed' WHEN running > 0 THEN 'running' WHEN pending > 0 THEN 'pending'
      WHEN shards = 0 THEN 'unplanned' WHEN issues > 0 THEN 'inconsistent' WHEN shards_done = shards AND ready THEN 'complete' ELSE 'finalizing' END AS state FROM b"""


def inputs(c, shards, candidates, strays=None):
    issues = L.reconcile(c.v_candidates, c.v_critic, c.v_tasks, c.v_samples, c.v_inventory, columns=("kind", "path", "candidate_id"))
    tables = {"critic_metrics": c.v_critic, "validation_tasks": c.v_tasks, "validation_structures": c.v_samples}
    return shards, candidates, C.candidate_facts(tables, issues, strays=strays), c.v_jobs, c.v_deps


@query("d7_campaign_state", _STATES)
def d7(c):
    """One campaign per order; a stray file's number names its campaign."""
    candidates = c.v_candidates.withColumn("shard_id", F.concat(F.lit("one_"), F.col("candidate_index").cast("string")))
    number = F.regexp_extract("path", r"(\d+)", 1).cast("bigint")
    return C.campaign_states(c.v_campaigns, C.campaign_numbers(*inputs(c, c.v_campaign_shards, candidates, number), c.v_artifacts))


@query(
    "d8_lifecycle_blockers",
    f"""WITH {COUNTS} SELECT string_agg(table_name || ' ' || status || '=' || n, '; ' ORDER BY table_name DESC,
        CASE status WHEN 'pending' THEN 0 WHEN 'running' THEN 1 ELSE 2 END) AS blockers FROM counts
        WHERE table_name IN ('validation_tasks', 'validation_msa_jobs') AND status IN ('pending', 'running', 'failed')""",
)
def d8(c):
    names = ("validation_tasks", "validation_msa_jobs")
    return L.lifecycle_blockers(L.status_counts({k: v for k, v in tables(c).items() if k in names}))


@query(
    "d9_validation_summary",
    f"""WITH {REFS}, t AS (SELECT *, output_structure_path AS validated_structure_path FROM v_tasks),
        a AS (SELECT count(*) AS planned_validation_count, count(*) FILTER (status = 'completed') AS completed_count,
          count(*) FILTER (status = 'failed') AS failed_count, count(*) FILTER (status = 'skipped') AS skipped_count,
          count(*) FILTER (status = 'pending') AS pending_count, count(*) FILTER (status = 'running') AS running_count,
          count(*) FILTER (status = 'completed' AND {PASSED}) AS completed_task_pass_count FROM t),
        b AS (SELECT count(*) FILTER (status = 'passing') AS passing_structure_count, count(*) FILTER (status = 'rejected') AS rejected_structure_count FROM v_samples),
        i AS (SELECT count(*) AS issues, count(*) FILTER (kind LIKE 'missing\\_%' ESCAPE '\\') AS missing_artifacts,
          count(*) FILTER (kind LIKE 'missing\\_validation%' ESCAPE '\\') AS missing_validation_artifacts, count(*) FILTER (kind = 'untracked_artifact') AS untracked_artifacts FROM issues)
        SELECT * FROM a, b, i""",
)
def d9(c):
    issues = L.reconcile(c.v_candidates, c.v_critic, c.v_tasks, c.v_samples, c.v_inventory)
    return L.validation_summary(c.v_tasks, c.v_samples, issues)


@query(
    "d10_analysis_summary",
    f"""WITH {SCORED} SELECT count(*) FILTER (ranking_eligible) AS ranked_designs, count(*) AS diagnostic_rows,
        count(*) FILTER (validator_passed = 'true') AS validator_pass_count, count(*) FILTER (validator_passed <> 'true') AS validator_reject_or_failed_count,
        count(*) FILTER (NOT ranking_eligible) AS ranking_ineligible_count, cast(84 AS bigint) AS top_k FROM sc""",
)
def d10(c):
    return X.analysis_summary(scored_rows(c), 84)


_SUMMARY = f"""WITH {METRICS}, {REFS}, {_facts_sql("v_shards", "c.shard_id", """UNION ALL SELECT campaign_id, t.tag, t.value FROM (SELECT candidate_id, unnest([
        {'tag': 'metric_rows', 'value': 'all'}, {'tag': 'iptm_scope', 'value': coalesce(nullif(metrics_json, '') ->> '$.iptm_scope', 'unknown')}, {'tag': 'framework', 'value': framework},
        {'tag': 'hotspot', 'value': CASE WHEN hd IS NOT NULL OR hc IS NOT NULL OR hotspot_satisfaction IS NOT NULL THEN 'measured' END},
        {'tag': 'hotspot', 'value': CASE WHEN hd <= hc THEN 'passed' END}]) AS t FROM cm) JOIN ow USING (candidate_id) WHERE t.value IS NOT NULL""")},
    k AS (SELECT campaign_id, tag, value, count(*) AS n FROM facts GROUP BY GROUPING SETS ((campaign_id, tag, value), (tag, value))),
    s AS (SELECT campaign_id, string_agg(tag || ':' || value || '=' || n, ';' ORDER BY tag, value) AS counts,
      cast(coalesce(sum(n) FILTER (tag = 'issues'), 0) AS bigint) AS issues, cast(coalesce(sum(n) FILTER (tag = 'issues' AND value LIKE 'missing%'), 0) AS bigint) AS missing_artifacts,
      cast(coalesce(sum(n) FILTER (tag = 'metric_rows'), 0) AS bigint) AS completed_metric_rows, cast(coalesce(sum(n) FILTER (value = 'measured'), 0) AS bigint) AS metric_rows,
      cast(coalesce(sum(n) FILTER (value = 'passed'), 0) AS bigint) AS pass_count FROM k GROUP BY campaign_id),
    t AS (SELECT campaign_id, string_agg(position || ' ' || candidate_id || ' ' || critic_name, ';' ORDER BY position) AS top FROM
      (SELECT campaign_id, candidate_id, critic_name, row_number() OVER (PARTITION BY campaign_id ORDER BY iptm DESC NULLS LAST, CASE WHEN binder_type IN ('scfv', 'vhh')
        THEN cdr_distogram_iptm_proxy ELSE distogram_iptm_proxy END DESC NULLS LAST, distogram_iptm_proxy DESC NULLS LAST, candidate_id, critic_name) AS position
       FROM cm JOIN ow USING (candidate_id)) WHERE position <= 10 GROUP BY 1)
    SELECT campaign_id, counts, issues, missing_artifacts, completed_metric_rows, metric_rows, pass_count, round(pass_count / nullif(metric_rows, 0), 6) AS pass_rate, top
    FROM s LEFT JOIN t USING (campaign_id)"""


@query("d11_campaign_summary", _SUMMARY)
def d11s(c):
    # The seed's place takes the campaign: a row's shard is met once.
    shards = c.v_shards.select("shard_id", F.col("campaign_id").alias("seed"))
    rows = G.metric_rows(L.completed_metrics(c.v_candidates, shards, c.v_critic)).withColumnRenamed("seed", "campaign_id")
    rows, keys = C.summary_rows(rows, X.selection_keys(), ["candidate_id", "critic_name"])
    tallied = C.tally(C.campaign_facts(*inputs(c, c.v_shards, c.v_candidates), metrics=rows))
    out = C.campaign_summary(tallied, rows, [F.col(k) for k in keys], ["candidate_id", "critic_name"])
    each = F.flatten(F.transform(F.map_entries("counts"), lambda t: F.transform(
        F.map_entries(t["value"]), lambda e: F.concat(t["key"], F.lit(":"), e["key"], F.lit("="), e["value"].cast("string"))
    )))
    listed = F.transform("top_candidates", lambda t: F.concat_ws(" ", t["position"].cast("string"), t["candidate_id"], t["critic_name"]))
    return out.select(
        "campaign_id", F.array_join(each, ";").alias("counts"), "issues", "missing_artifacts", "completed_metric_rows", "metric_rows", "pass_count",
        F.round("pass_rate", 6).alias("pass_rate"), F.array_join(listed, ";").alias("top"),
    )


@query(
    "d11_framework_summary",
    f"""WITH {METRICS} SELECT coalesce(framework, 'unknown') AS framework, count(*) AS completed_metric_rows,
        count(*) FILTER (hd IS NOT NULL OR hc IS NOT NULL OR hotspot_satisfaction IS NOT NULL) AS metric_rows,
        count(*) FILTER (hd <= hc) AS pass_count, max(iptm) AS best_iptm FROM cm GROUP BY 1""",
)
def d11(c):
    rows = metric_rows(c).withColumn("framework", F.coalesce("framework", F.lit("unknown")))
    measured = G.has_hotspot_metrics(flag="hotspot_pass")
    return rows.groupBy("framework").agg(
        F.count(F.lit(1)).alias("completed_metric_rows"), F.count_if(measured).alias("metric_rows"),
        F.count_if(G.has_hotspot_contact()).alias("pass_count"), F.max("iptm").alias("best_iptm"),
    )


@query(
    "d12_pose_summary",
    "SELECT count(*) AS row_count, count(rmsd) AS rows_with_binder_ca_rmsd, count(*) - count(rmsd) AS rows_missing_binder_ca_rmsd FROM v_tasks",
)
def d12(c):
    return L.pose_summary(c.v_tasks)


@query(
    "d13_config_variants",
    """WITH n AS (SELECT candidate_id, model_name, count(DISTINCT validation_config_hash) AS config_count FROM v_tasks GROUP BY 1, 2)
       SELECT validation_id, config_count, config_count > 1 AS needs_suffix FROM v_tasks JOIN n USING (candidate_id, model_name)""",
)
def d13(c):
    return L.config_variants(c.v_tasks)


@query("d14_worker_completions", "SELECT worker_id, count(*) AS completed FROM v_attempts WHERE status = 'completed' AND stage = 'validation' GROUP BY 1")
def d14(c):
    return L.worker_completions(c.v_attempts, "validation")


@query("d36_score_correlation", f"""WITH {TASKS}, p AS (SELECT critic_iptm AS x, validator_iptm AS y, validation_id FROM rr WHERE critic_iptm IS NOT NULL AND validator_iptm IS NOT NULL),
    r AS (SELECT *, row_number() OVER (ORDER BY x, validation_id) AS rx, row_number() OVER (ORDER BY y, validation_id) AS ry FROM p)
    SELECT count(*) AS n, round(corr(x, y), 6) AS pearson, round(corr(rx, ry), 6) AS spearman FROM r""")
def d36(c):
    out = X.score_correlation(task_rows(c), "critic_iptm", "validator_iptm", "validation_id")
    return out.select("n", F.round("pearson", 6).alias("pearson"), F.round("spearman", 6).alias("spearman"))


@query("d37_scatter_points", f"""WITH {TASKS} SELECT validation_id, critic_iptm AS x, validator_iptm AS y, greatest(0, least(rmsd * 10, 20)) AS color,
    NOT coalesce(validator_passed = 'true', false) AS rejected FROM (SELECT * REPLACE (rmsd AS rmsd) FROM rr) WHERE critic_iptm IS NOT NULL AND validator_iptm IS NOT NULL""")
def d37(c):
    rows = task_rows(c).withColumn("rmsd", F.col("rmsd") * 10)
    return X.scatter_points(rows, "critic_iptm", "validator_iptm", "rmsd")
