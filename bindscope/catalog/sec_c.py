"""Joins over the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.catalog.fragments import METRICS, SRC, TASKS, completed, task_rows
from bindscope.functions import scalars as S
from bindscope.operators import ledger as L


@query("c1_completed_metrics", f"WITH {METRICS} SELECT candidate_id, seed, critic_name, designed_sequence, iptm, structure_path FROM cm")
def c1(c):
    return completed(c).select("candidate_id", "seed", "critic_name", "designed_sequence", "iptm", "structure_path")


@query("c2_source_critic", f"WITH {SRC} SELECT candidate_id, critic_name, iptm, structure_path FROM src")
def c2(c):
    return L.source_critic(c.v_critic.select("candidate_id", "critic_name", "status", "iptm", "structure_path")).select(
        "candidate_id", "critic_name", "iptm", "structure_path"
    )


@query(
    "c3_task_report",
    f"""WITH {TASKS} SELECT validation_id, candidate_id, model_name, seed, designed_sequence, framework, validator_status,
        validator_iptm, source_critic, critic_iptm, source_structure_path FROM rr""",
)
def c3(c):
    return task_rows(c).select(
        "validation_id", "candidate_id", "model_name", "seed", "designed_sequence", "framework", "validator_status",
        "validator_iptm", "source_critic", "critic_iptm", "source_structure_path",
    )


@query(
    "c4_structure_report",
    f"""WITH {SRC} SELECT x.structure_id, x.validation_id, x.candidate_id, x.seed, x.sample_rank, x.status AS structure_status,
        t.selection_rank, c.designed_sequence, s.critic_name AS source_critic, s.iptm AS critic_iptm
        FROM v_samples x JOIN v_tasks t USING (validation_id) JOIN v_candidates c ON c.candidate_id = x.candidate_id
        LEFT JOIN src s ON s.candidate_id = x.candidate_id""",
)
def c4(c):
    return L.structure_rows(c.v_samples, c.v_tasks, c.v_candidates, c.v_critic).select(
        "structure_id", "validation_id", "candidate_id", "seed", "sample_rank", "structure_status", "selection_rank",
        "designed_sequence", "source_critic", "critic_iptm",
    )


_READY = """ready AS (SELECT * FROM v_tasks t WHERE status = 'pending' AND attempt_count < max_attempts AND NOT EXISTS (
    SELECT 1 FROM v_deps d JOIN v_jobs j USING (msa_job_id) WHERE d.candidate_id = t.candidate_id
    AND d.validation_config_hash = t.validation_config_hash AND j.status NOT IN ('ready', 'skipped')))"""


@query("c5_ready_tasks", f"WITH {_READY} SELECT validation_id, candidate_id, selection_rank FROM ready")
def c5(c):
    return L.ready_tasks(c.v_tasks, c.v_deps, c.v_jobs).select("validation_id", "candidate_id", "selection_rank")


@query(
    "c6_blocked_counts",
    """SELECT j.status AS job_status, count(DISTINCT t.validation_id) AS tasks FROM v_tasks t JOIN v_deps d
       ON d.candidate_id = t.candidate_id AND d.validation_config_hash = t.validation_config_hash
       JOIN v_jobs j USING (msa_job_id) WHERE t.status = 'pending' AND j.status NOT IN ('ready', 'skipped') GROUP BY 1""",
)
def c6(c):
    return L.blocked_counts(c.v_tasks, c.v_deps, c.v_jobs)


@query(
    "c7_job_failures",
    """SELECT j.msa_job_id, j.scope, coalesce(j.error_message, '') AS error_message, d.candidate_id
       FROM v_jobs j LEFT JOIN v_deps d USING (msa_job_id) WHERE j.status = 'failed'""",
)
def c7(c):
    return L.job_failures(c.v_jobs, c.v_deps).select("msa_job_id", "scope", "error_message", "candidate_id")


REFS = """refs AS MATERIALIZED (SELECT 'missing_sequence_artifact' AS kind, sequence_path AS path, 'candidates' AS table_name, candidate_id AS row_id FROM v_candidates
    UNION ALL SELECT 'missing_structure_artifact', structure_path, 'critic_metrics', candidate_id || ':' || critic_name FROM v_critic
    UNION ALL SELECT 'missing_validation_artifact', output_structure_path, 'validation_tasks', validation_id FROM v_tasks
    UNION ALL SELECT 'missing_validation_artifact', structure_path, 'validation_structures', validation_id || ':' || structure_id FROM v_samples),
  issues AS (SELECT coalesce(r.kind, 'untracked_artifact') AS kind, coalesce(r.path, i.path) AS path, r.table_name, r.row_id FROM refs r FULL JOIN v_inventory i ON i.path = r.path
    WHERE i.path IS NULL OR (r.path IS NULL AND starts_with(i.path, 'shards/')))"""


@query("c8_reconcile", f"WITH {REFS} SELECT * FROM issues")
def c8(c):
    return L.reconcile(c.v_candidates, c.v_critic, c.v_tasks, c.v_samples, c.v_inventory)


@query(
    "c9_resolve_framework",
    """WITH q AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 3 = 0 THEN 'ALIAS_' ELSE 'other_' END || l_partkey AS name FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, name, coalesce(a.canonical, q.name) AS canonical
       FROM q LEFT JOIN v_aliases a ON lower(a.alias) = lower(q.name)""",
)
def c9(c):
    name = F.concat(F.when(F.col("l_partkey") % 3 == 0, "ALIAS_").otherwise("other_"), F.col("l_partkey").cast("string"))
    q = c.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", name.alias("name"))
    return L.resolve_alias(q, "name", c.v_aliases).select("l_orderkey", "l_linenumber", "l_partkey", "name", "canonical")


@query(
    "c10_priority_lookup",
    """WITH m AS (SELECT s_suppkey, s_suppkey % 40 AS nm, s_suppkey % 7 AS lb, s_suppkey % 90 AS sq FROM supplier),
       q AS (SELECT c_custkey, c_custkey % 60 AS nm, c_custkey % 9 AS lb, c_custkey % 150 AS sq FROM customer),
       mk AS (SELECT 0 AS p, nm || '|' || sq AS k, s_suppkey FROM m UNION ALL SELECT 1, lb || '|' || sq, s_suppkey FROM m
         UNION ALL SELECT 2, cast(sq AS varchar), s_suppkey FROM m UNION ALL SELECT 3, cast(nm AS varchar), s_suppkey FROM m
         UNION ALL SELECT 4, cast(lb AS varchar), s_suppkey FROM m),
       last AS (SELECT p, k, max(s_suppkey) AS s_suppkey FROM mk GROUP BY p, k),
       qk AS (SELECT 0 AS p, nm || '|' || sq AS k, c_custkey FROM q UNION ALL SELECT 1, lb || '|' || sq, c_custkey FROM q
         UNION ALL SELECT 2, cast(sq AS varchar), c_custkey FROM q UNION ALL SELECT 3, cast(nm AS varchar), c_custkey FROM q
         UNION ALL SELECT 4, cast(lb AS varchar), c_custkey FROM q),
       hit AS (SELECT c_custkey, s_suppkey, p, row_number() OVER (PARTITION BY c_custkey ORDER BY p) AS rn FROM qk JOIN last USING (p, k))
       SELECT q.c_custkey, h.s_suppkey, cast(h.p AS int) AS matched_by FROM q LEFT JOIN hit h ON h.c_custkey = q.c_custkey AND h.rn = 1""",
)
def c10(c):
    def keys():
        text = lambda n: F.col(n).cast("string")
        return [F.concat_ws("|", "nm", "sq"), F.concat_ws("|", "lb", "sq"), text("sq"), text("nm"), text("lb")]

    m = c.supplier.select("s_suppkey", (F.col("s_suppkey") % 40).alias("nm"), (F.col("s_suppkey") % 7).alias("lb"), (F.col("s_suppkey") % 90).alias("sq"))
    m = m.withColumn("file_order", F.col("s_suppkey"))
    q = c.customer.select("c_custkey", (F.col("c_custkey") % 60).alias("nm"), (F.col("c_custkey") % 9).alias("lb"), (F.col("c_custkey") % 150).alias("sq"))
    return L.priority_lookup(q, "c_custkey", keys(), m, keys(), "s_suppkey", "file_order").select("c_custkey", "s_suppkey", "matched_by")


@query(
    "c18_cached_msa",
    """WITH r AS (SELECT candidate_id, sha256(designed_sequence) AS seq_sha256, 'ctx_' || candidate_index % 3 AS context_hash FROM v_candidates),
       x AS (SELECT sha256(representative_sequence) AS seq_sha256, msa_context_hash AS context_hash, min(msa_job_id) AS cache_id,
             max(s_suppkey % 5) AS size FROM v_jobs GROUP BY 1, 2)
       SELECT candidate_id, x.cache_id, coalesce(x.size > 0, false) AS usable FROM r LEFT JOIN x USING (seq_sha256, context_hash)""",
)
def c18(c):
    from bindscope.operators.msa import cached_msa

    requests = c.v_candidates.select(
        "candidate_id", F.sha2("designed_sequence", 256).alias("seq_sha256"),
        F.concat(F.lit("ctx_"), (F.col("candidate_index") % 3).cast("string")).alias("context_hash"),
    )
    index = c.v_jobs.groupBy(F.sha2("representative_sequence", 256).alias("seq_sha256"), F.col("msa_context_hash").alias("context_hash")).agg(
        F.min("msa_job_id").alias("cache_id"), F.max(F.col("s_suppkey") % 5).alias("size")
    )
    return cached_msa(requests, index).select("candidate_id", "cache_id", "usable")


@query(
    "c19_template_available",
    """WITH t AS (SELECT l_orderkey AS k, l_linenumber AS o, CASE WHEN l_orderkey % 4 = 0 THEN '' ELSE ' ' || lower(min(l_returnflag)) END AS s FROM lineitem GROUP BY 1, 2),
       w AS (SELECT l_orderkey AS k, l_linenumber AS o, max(l_returnflag) AS s FROM lineitem WHERE l_linestatus = 'O' OR l_linenumber < 3 GROUP BY 1, 2)
       SELECT coalesce(t.k, w.k) AS target, bool_and(t.k IS NOT NULL AND w.k IS NOT NULL AND (t.s = '' OR upper(trim(t.s)) = w.s)) AS available
       FROM t FULL JOIN w ON t.k = w.k AND t.o = w.o GROUP BY 1""",
)
def c19(c):
    li = c.lineitem
    key = [F.col("l_orderkey").alias("target"), F.col("l_linenumber").alias("ordinal")]
    t = li.groupBy(*key).agg(F.min("l_returnflag").alias("s")).select(
        "target", "ordinal", F.when(F.col("target") % 4 == 0, "").otherwise(F.concat(F.lit(" "), F.lower("s"))).alias("sequence")
    )
    w = li.filter("l_linestatus = 'O' or l_linenumber < 3").groupBy(*key).agg(F.max("l_returnflag").alias("sequence"))
    return L.template_available(t, w, ["target"])


@query(
    "c20_plan_tasks",
    """WITH p AS (SELECT candidate_id, 'model_o' AS model_name, 'cfg_a' AS validation_config_hash FROM v_candidates)
       SELECT candidate_id, CASE WHEN EXISTS (SELECT 1 FROM v_tasks t WHERE t.candidate_id = p.candidate_id AND t.model_name = p.model_name
         AND t.validation_config_hash = p.validation_config_hash) THEN 'existing' ELSE 'created' END AS outcome FROM p""",
)
def c20(c):
    plan = c.v_candidates.select("candidate_id", F.lit("model_o").alias("model_name"), F.lit("cfg_a").alias("validation_config_hash"))
    return L.plan_split(plan, c.v_tasks, ["candidate_id", "model_name", "validation_config_hash"]).select("candidate_id", "outcome")
