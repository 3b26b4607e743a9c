"""Windows, ranking and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.catalog.fragments import METRICS, SCORED, TASKS, completed, metric_rows, scored_rows, task_rows
from bindscope.catalog.sec_c import _READY, REFS
from bindscope.operators import gating as G
from bindscope.operators import ledger as L
from bindscope.operators import ranking as R
from bindscope.operators import selection as X

_ORDER = """iptm DESC NULLS LAST, CASE WHEN binder_type IN ('scfv', 'vhh') THEN cdr_distogram_iptm_proxy ELSE distogram_iptm_proxy END DESC NULLS LAST,
    distogram_iptm_proxy DESC NULLS LAST, candidate_id, critic_name"""
_POOL = f"""pool AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY designed_sequence ORDER BY {_ORDER}) AS rn FROM cm
    WHERE iptm >= 0.3 AND coalesce(hd <= hc, false)) WHERE rn = 1)"""


@query("e1_dedup_best_by_sequence", f"""WITH {METRICS} SELECT designed_sequence, candidate_id, critic_name, iptm FROM
    (SELECT *, row_number() OVER (PARTITION BY designed_sequence ORDER BY {_ORDER}) AS rn FROM cm) WHERE rn = 1""")
def e1(c):
    return R.dedup_best(metric_rows(c), "designed_sequence", X.selection_keys()).select("designed_sequence", "candidate_id", "critic_name", "iptm")


@query("e2_select_designs", f"""WITH {METRICS}, {_POOL} SELECT row_number() OVER (ORDER BY {_ORDER}) AS rank, candidate_id, critic_name, designed_sequence, iptm
    FROM pool QUALIFY rank <= 100""")
def e2(c):
    return X.select_designs(metric_rows(c), 100, 0.3).select("rank", "candidate_id", "critic_name", "designed_sequence", "iptm")


@query("e3_plan_selection", f"""WITH {METRICS}, {_POOL} SELECT 'val_' || candidate_id || '_' || substr(sha256(candidate_id || '|model_x|cfg_z'), 1, 10) AS validation_id,
    candidate_id, row_number() OVER (ORDER BY {_ORDER}) AS selection_rank FROM pool""")
def e3(c):
    return X.plan_selection(metric_rows(c), "model_x", "cfg_z", 0.3).select("validation_id", "candidate_id", "selection_rank")


_STATUS = "CASE {0} WHEN 'completed' THEN 0 WHEN 'running' THEN 1 WHEN 'pending' THEN 2 WHEN 'skipped' THEN 3 WHEN 'failed' THEN 4 ELSE 5 END"


@query("e4_validation_rank", f"""WITH {TASKS} SELECT validation_id, model_name, row_number() OVER (PARTITION BY model_name ORDER BY {_STATUS.format('validator_status')},
    validator_iptm DESC NULLS LAST, validator_ipsae DESC NULLS LAST, validator_ranking_score DESC NULLS LAST,
    coalesce(nullif(selection_rank, 0), 1000000000), validation_id) AS validation_rank FROM rr""")
def e4(c):
    return X.validation_rank(task_rows(c), ["validation_id", "model_name"])


@query("e5_order_samples", """SELECT structure_id, model_name, row_number() OVER (PARTITION BY model_name ORDER BY CASE WHEN status = 'passing' THEN 0 ELSE 1 END,
    scoped_iptm DESC NULLS LAST, scoped_ipsae DESC NULLS LAST, ranking_score DESC NULLS LAST, seed, sample_rank, structure_id) AS sample_order FROM v_samples""")
def e5(c):
    rows = c.v_samples.select(
        "structure_id", "model_name", F.col("status").alias("structure_status"), F.col("scoped_iptm").alias("validator_iptm"),
        F.col("scoped_ipsae").alias("validator_ipsae"), F.col("ranking_score").alias("validator_ranking_score"), "seed", "sample_rank",
    )
    return X.order_samples(rows, ["structure_id", "model_name"])


@query("e6_best_sample", """SELECT validation_id, structure_id, status, scoped_iptm FROM (SELECT *, row_number() OVER (PARTITION BY validation_id
    ORDER BY CASE WHEN status = 'passing' THEN 0 ELSE 1 END, coalesce(scoped_iptm, -1) DESC, coalesce(scoped_ipsae, -1) DESC,
    coalesce(ranking_score, -1) DESC, sample_rank, seed, structure_id) AS rn FROM v_samples) WHERE rn = 1""")
def e6(c):
    return X.best_sample(c.v_samples).select("validation_id", "structure_id", "status", "scoped_iptm")


@query("e7_consensus_score", f"""WITH {SCORED} SELECT validation_id, round(ev, 6) AS evaluator_score, round(confidence_score, 6) AS confidence_score,
    round(agreement_score, 6) AS agreement_score, round(pow(confidence_score, 0.7) * pow(agreement_score, 0.3), 6) AS final_score,
    CASE WHEN vi IS NOT NULL AND vs IS NOT NULL THEN 'critic_iptm+validator_iptm+validator_ipsae' ELSE 'critic_iptm+validator_iptm' END AS metric_basis FROM sc""")
def e7(c):
    cfg = G.RankingConfig(rmsd_weight=0.3)
    return G.consensus_score(task_rows(c), cfg).select(
        "validation_id", *[F.round(n, 6).alias(n) for n in ("evaluator_score", "confidence_score", "agreement_score", "final_score")], "metric_basis"
    )


@query("e8_validator_rank", f"""WITH {SCORED}, k AS (SELECT validation_id, row_number() OVER (ORDER BY ev DESC, validator_iptm DESC NULLS LAST,
    validator_ipsae DESC NULLS LAST, candidate_id, validation_id) AS r FROM sc WHERE validator_status = 'completed' AND ev IS NOT NULL)
    SELECT sc.validation_id, k.r AS validator_rank FROM sc LEFT JOIN k USING (validation_id)""")
def e8(c):
    return X.validator_rank(scored_rows(c), ["validation_id"])


FINAL = f"""fin AS (SELECT *, CASE WHEN ranking_eligible THEN row_number() OVER (PARTITION BY ranking_eligible ORDER BY {_STATUS.format('validator_status')},
    CASE WHEN validator_passed = 'true' THEN 0 ELSE 1 END, confidence_score DESC NULLS LAST, rmsd ASC NULLS LAST, ev DESC NULLS LAST, critic_iptm DESC NULLS LAST,
    coalesce(nullif(selection_rank, 0), 1000000000), candidate_id, validation_id) END AS final_rank FROM sc)"""


@query("e9_final_rank", f"WITH {SCORED}, {FINAL} SELECT validation_id, ranking_eligible, final_rank FROM fin")
def e9(c):
    return X.final_rank(scored_rows(c), ["validation_id", "ranking_eligible"])


@query("e11_compact_ranking", f"""WITH {SCORED}, {FINAL} SELECT final_rank AS rank, candidate_id AS design_name, designed_sequence AS sequence, framework,
    round(confidence_score, 6) AS consensus_score, selection_rank AS critic_rank, critic_iptm, validator_iptm, validator_ipsae, rmsd AS binder_rmsd_angstrom,
    source_structure_path AS critic_structure, validated_structure_path AS validator_structure FROM fin WHERE ranking_eligible""")
def e11(c):
    scored = scored_rows(c)
    ranked = X.final_rank(scored, [*G.compact_sources(scored), "ranking_eligible"]).filter("ranking_eligible")
    return G.compact_ranking(ranked).withColumn("consensus_score", F.round("consensus_score", 6))


@query("f1_multi_key_order", f"WITH {METRICS} SELECT candidate_id, critic_name, row_number() OVER (ORDER BY {_ORDER}) AS position FROM cm")
def f1(c):
    return R.add_rank(metric_rows(c), X.selection_keys(), "position", columns=["candidate_id", "critic_name"])


@query("f2_top_n", """SELECT candidate_id, critic_name, iptm FROM v_critic ORDER BY iptm DESC NULLS LAST, candidate_id, critic_name LIMIT 250""")
def f2(c):
    keys = [R.high_first("iptm"), R.text_first("candidate_id"), R.text_first("critic_name")]
    return R.top_n(c.v_critic.select("candidate_id", "critic_name", "iptm"), keys, 250)


@query("f3_top_summaries", f"""WITH {SCORED}, {FINAL} SELECT final_rank AS position, '{{"candidate_id":"' || candidate_id || '","model_name":"' || model_name || '"' ||
    CASE WHEN framework IS NULL THEN '' ELSE ',"framework":"' || framework || '"' END || '}}' AS summary FROM fin WHERE final_rank <= 10""")
def f3(c):
    eligible = scored_rows(c).filter("ranking_eligible")
    return X.top_summaries(eligible, X.final_keys(), ["candidate_id", "model_name", "framework"])


@query("f4_next_batch", f"WITH {_READY} SELECT validation_id, selection_rank FROM ready ORDER BY selection_rank NULLS LAST, validation_id LIMIT 64")
def f4(c):
    ready = L.ready_tasks(c.v_tasks, c.v_deps, c.v_jobs).select("validation_id", "selection_rank")
    return L.next_batch(ready, 64)


@query("f5_issue_order", f"WITH {REFS} SELECT kind, path, coalesce(row_id, '') AS row_id, row_number() OVER (ORDER BY kind, path, coalesce(row_id, '')) AS position FROM issues")
def f5(c):
    issues = L.reconcile(c.v_candidates, c.v_critic, c.v_tasks, c.v_samples, c.v_inventory)
    keys = [F.col("kind"), F.col("path"), R.text_first("row_id")]
    return R.add_rank(issues.withColumn("row_id", F.coalesce("row_id", F.lit(""))), keys, "position", columns=["kind", "path", "row_id"])
