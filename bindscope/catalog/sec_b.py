"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.catalog.fragments import METRICS, PASSED, TASKS, completed, metric_rows, task_rows
from bindscope.functions import scalars as S
from bindscope.operators import gating as G


@query(
    "b1_metric_rows",
    f"""WITH {METRICS} SELECT candidate_id, critic_name, seed, binder_type, scaffold AS binder_scaffold, framework,
        cast(length(designed_sequence) AS int) AS binder_length, binder_chain_id, sequence_path, structure_path, iptm,
        nullif(metrics_json, '') ->> '$.iptm_scope' AS iptm_scope,
        CASE WHEN metrics_json LIKE '%"ptm":null%' THEN NULL ELSE ptm END AS ptm,
        coalesce(cast(nullif(metrics_json, '') ->> '$.plddt' AS double), plddt) AS plddt_complex,
        hd AS hotspot_distance_angstrom, hc AS hotspot_cutoff, hotspot_satisfaction > 0 AS hotspot_pass,
        CASE WHEN design_metrics_json LIKE '%"final_loss":null%' THEN NULL
             ELSE cast(design_metrics_json ->> '$.loss' AS double) END AS final_loss,
        design_metrics_json ->> '$.target_name' AS target_name,
        distogram_iptm_proxy, cdr_distogram_iptm_proxy FROM cm""",
)
def b1(c):
    rows = metric_rows(c)
    return rows.select(
        "candidate_id", "critic_name", "seed", "binder_type",
        F.when(F.col("binder_type") == "mp", "miniprotein").otherwise(F.regexp_replace("binder_scaffold", "_", "")).alias("binder_scaffold"),
        "framework", "binder_length", "binder_chain_id", "sequence_path", "structure_path", "iptm", "iptm_scope", "ptm",
        "plddt_complex", "hotspot_distance_angstrom", "hotspot_cutoff", "hotspot_pass", "final_loss", "target_name",
        "distogram_iptm_proxy", "cdr_distogram_iptm_proxy",
    )


@query(
    "b2_first_present",
    """SELECT candidate_id, CASE WHEN candidate_index % 4 = 0 THEN NULL ELSE design_metrics_json ->> '$.loss' END AS final_loss,
       design_metrics_json ->> '$.framework_name' AS framework FROM v_candidates""",
)
def b2(c):
    doc = S.decode_metrics("design_metrics_json", "candidate_id")
    return c.v_candidates.withColumn("d", doc).select(
        "candidate_id",
        S.first_present("d", F.create_map().cast(S.JSON_MAP), G.FINAL_LOSS_KEYS).alias("final_loss"),
        S.first_present("d", None, G.FRAMEWORK_KEYS).alias("framework"),
    )


@query(
    "b3_first_nonempty",
    """SELECT validation_id, coalesce(nullif(validator_passed, ''), nullif(claim_worker_id, ''), model_name) AS value,
       coalesce(claim_worker_id, model_name) AS first_not_null FROM v_tasks""",
)
def b3(c):
    return c.v_tasks.select(
        "validation_id", S.first_nonempty("validator_passed", "claim_worker_id", "model_name").alias("value"),
        F.coalesce("claim_worker_id", "model_name").alias("first_not_null"),
    )


@query("b4_min_score_filter", "SELECT candidate_id, critic_name, iptm FROM v_critic WHERE iptm >= 0.3")
def b4(c):
    return G.filter_min(c.v_critic, "iptm", 0.3).select("candidate_id", "critic_name", "iptm")


@query("b5_prune_empty_columns", "SELECT candidate_id, critic_name, iptm_scope FROM (SELECT candidate_id, critic_name, nullif(metrics_json, '') ->> '$.iptm_scope' AS iptm_scope FROM v_critic)")
def b5(c):
    doc = S.decode_metrics("metrics_json", "candidate_id")
    wide = c.v_critic.withColumn("d", doc).select(
        "candidate_id", "critic_name",
        *[F.try_element_at("d", F.lit(k)).alias(k) for k in ("iptm_scope", "complex_iptm", "plddt_binder")],
    )
    order = ["candidate_id", "critic_name", "iptm_scope", "complex_iptm", "plddt_binder"]
    return G.prune_empty(wide, ["iptm_scope", "complex_iptm", "plddt_binder"], order)


@query(
    "b6_hotspot_contact",
    """SELECT candidate_id, critic_name, coalesce(hotspot_distance_angstrom <= hotspot_cutoff, false) AS contact,
       hotspot_distance_angstrom IS NOT NULL OR hotspot_cutoff IS NOT NULL AS has_metrics FROM v_critic""",
)
def b6(c):
    return c.v_critic.select(
        "candidate_id", "critic_name", G.has_hotspot_contact().alias("contact"), G.has_hotspot_metrics().alias("has_metrics")
    )


@query(
    "b7_hotspot_gate_auto",
    """WITH p AS (SELECT * FROM v_critic WHERE iptm >= 0.3),
       f AS (SELECT bool_or(hotspot_distance_angstrom IS NOT NULL OR hotspot_cutoff IS NOT NULL) AS needed FROM p)
       SELECT candidate_id, critic_name FROM p WHERE coalesce(hotspot_distance_angstrom <= hotspot_cutoff, false)
       OR NOT (SELECT needed FROM f)""",
)
def b7(c):
    return G.hotspot_gate(G.filter_min(c.v_critic, "iptm", 0.3), "auto").select("candidate_id", "critic_name")


@query(
    "b8_lenient_casts",
    """SELECT validation_id, try_cast(validator_passed AS double) AS as_float,
       CASE lower(trim(validator_passed)) WHEN 'true' THEN true WHEN 'no' THEN false END AS as_bool,
       try_cast(selection_rank AS bigint) AS as_int, cast(NULL AS boolean) AS int_as_bool FROM v_tasks""",
)
def b8(c):
    return c.v_tasks.select(
        "validation_id", S.opt_float("validator_passed").alias("as_float"), S.opt_bool("validator_passed").alias("as_bool"),
        S.opt_int("selection_rank").alias("as_int"), S.opt_bool("attempt_count", "bigint").alias("int_as_bool"),
    )


@query(
    "b9_binder_type",
    """SELECT candidate_id, CASE binder_scaffold WHEN 'miniprotein' THEN 'mp' ELSE binder_scaffold END AS binder_type,
       lower(trim(design_metrics_json ->> '$.binder_scaffold')) AS binder_scaffold FROM v_candidates""",
)
def b9(c):
    d = c.v_candidates.withColumn("d", S.decode_metrics("design_metrics_json", "candidate_id"))
    d = d.withColumn("binder_type", G.binder_type("d"))
    return d.select("candidate_id", "binder_type", G.binder_scaffold("d", F.col("binder_type")).alias("binder_scaffold"))


@query(
    "b10_cdr_columns",
    """WITH d AS (SELECT candidate_id, binder_scaffold = 'vhh' AS single, design_metrics_json -> '$.cdr_sequences' AS j FROM v_candidates)
       SELECT candidate_id,
         CASE WHEN single THEN nullif(j ->> '$.hcdr1', '') END AS hcdr1, CASE WHEN single THEN nullif(j ->> '$.hcdr2', '') END AS hcdr2,
         CASE WHEN single THEN nullif(j ->> '$.hcdr3', '') END AS hcdr3, CASE WHEN NOT single THEN nullif(j ->> '$.hcdr1', '') END AS cdrh1,
         CASE WHEN NOT single THEN nullif(j ->> '$.hcdr2', '') END AS cdrh2, CASE WHEN NOT single THEN nullif(j ->> '$.hcdr3', '') END AS cdrh3,
         CASE WHEN NOT single THEN nullif(j ->> '$.lcdr1', '') END AS cdrl1, CASE WHEN NOT single THEN nullif(j ->> '$.lcdr2', '') END AS cdrl2,
         CASE WHEN NOT single THEN nullif(j ->> '$.lcdr3', '') END AS cdrl3 FROM d""",
)
def b10(c):
    d = c.v_candidates.withColumn("d", S.decode_metrics("design_metrics_json", "candidate_id"))
    cdr = F.from_json(F.try_element_at("d", F.lit("cdr_sequences")), S.JSON_MAP)
    d = d.withColumn("cdr", cdr).withColumn("kind", G.binder_type("d"))
    cols = G.cdr_columns(F.col("cdr"), F.col("kind"))
    return d.select("candidate_id", *[v.alias(k) for k, v in cols.items()])


_GATE = """WITH g AS (SELECT structure_id, scoped_iptm AS vi, scoped_ipsae AS vs FROM v_samples),
    r AS (SELECT structure_id, vs, list_filter([
        CASE WHEN vi IS NULL THEN 'missing scoped binder-target chain_pair_iptm' END,
        CASE WHEN vs IS NULL THEN 'missing scoped binder-target validation_ipSAE' END,
        CASE WHEN vi < 0.5 THEN 'validation_iptm ' || printf('%.4f', vi) || ' below threshold 0.5000' END,
        CASE WHEN vs < 0.4 THEN 'validation_ipSAE ' || printf('%.4f', vs) || ' below threshold 0.4000' END],
        lambda x: x IS NOT NULL) AS reasons FROM g)"""


@query(
    "b11_validator_gate",
    _GATE + """ SELECT structure_id, len(reasons) = 0 AS gate_passed, nullif(array_to_string(reasons, '; '), '') AS fail_reason,
    coalesce(vs >= 0.4, false) AS ipsae_pass FROM r""",
)
def b11(c):
    rows = c.v_samples.select("structure_id", F.col("scoped_iptm").alias("validation_iptm"), F.col("scoped_ipsae").alias("validation_ipsae"))
    return G.validator_gate(rows, 0.5, 0.4).select("structure_id", "gate_passed", "fail_reason", "ipsae_pass")


@query(
    "b12_merge_hotspot_verdict",
    _GATE + """, h AS (SELECT structure_id, ranking_score >= 0.3 AS hp FROM v_samples)
    SELECT structure_id, len(reasons) = 0 AND hp AS gate_passed,
      nullif(array_to_string(list_filter([nullif(array_to_string(reasons, '; '), ''),
        CASE WHEN NOT hp THEN 'validation hotspot distance exceeds cutoff' END], lambda x: x IS NOT NULL), '; '), '') AS fail_reason
    FROM r JOIN h USING (structure_id)""",
)
def b12(c):
    rows = c.v_samples.select(
        "structure_id", F.col("scoped_iptm").alias("validation_iptm"), F.col("scoped_ipsae").alias("validation_ipsae"),
        (F.col("ranking_score") >= 0.3).alias("hotspot_pass"),
    ).withColumn("hotspot_fail_reason", F.when(~F.col("hotspot_pass"), "validation hotspot distance exceeds cutoff"))
    return G.merge_hotspot_verdict(G.validator_gate(rows, 0.5, 0.4)).select("structure_id", "gate_passed", "fail_reason")


@query("b13_validation_passed", f"WITH {TASKS} SELECT validation_id, {PASSED} AS passed FROM rr")
def b13(c):
    return task_rows(c).select("validation_id", G.validation_passed("validator_passed", "validated_structure_path").alias("passed"))


@query(
    "b14_ranking_eligibility",
    f"""WITH {TASKS}, r AS (SELECT validation_id, rmsd, list_filter([
        CASE WHEN validator_status <> 'completed' THEN 'validator status is not completed' END,
        CASE WHEN NOT {PASSED} THEN 'validator did not pass' END,
        CASE WHEN critic_iptm IS NULL OR critic_iptm NOT BETWEEN 0 AND 1 THEN 'missing or invalid critic ipTM' END,
        CASE WHEN validator_iptm IS NULL OR validator_iptm NOT BETWEEN 0 AND 1 THEN 'missing or invalid validator ipTM' END,
        CASE WHEN validator_ipsae NOT BETWEEN 0 AND 1 THEN 'invalid validator ipSAE' END,
        CASE WHEN rmsd IS NULL THEN 'missing binder CA RMSD after target alignment' END,
        CASE WHEN rmsd > 2.5 THEN 'binder CA RMSD ' || printf('%.3f', rmsd) || ' exceeds 2.500 angstrom' END],
        lambda x: x IS NOT NULL) AS reasons FROM rr)
      SELECT validation_id, len(reasons) = 0 AS ranking_eligible, nullif(array_to_string(reasons, '; '), '') AS ranking_exclusion_reason,
        rmsd <= 2.5 AS rmsd_pass FROM r""",
)
def b14(c):
    return G.ranking_eligibility(task_rows(c), G.RankingConfig()).select(
        "validation_id", "ranking_eligible", "ranking_exclusion_reason", "rmsd_pass"
    )


def _planned(c):
    return c.v_candidates.join(c.v_shards.select("shard_id", "seed"), "shard_id").select(
        "candidate_id", F.col("binder_scaffold").alias("scaffold"),
        F.coalesce(F.col("framework").isin("fw_1", "fw_2", "fw_3"), F.lit(False)).alias("has_template"),
        (F.length("designed_sequence") + F.col("seed") % 300).cast("bigint").alias("token_count"),
        (F.col("candidate_index") % 10 / 10.0).alias("iptm"),
        F.when(F.col("candidate_index") % 3 == 0, F.col("candidate_index") % 2 == 0).alias("hotspot_pass"),
        (F.col("candidate_index") % 5 - 2).alias("hotspot_satisfaction"),
    )


_PLANNED = """p AS (SELECT candidate_id, binder_scaffold AS scaffold, coalesce(framework IN ('fw_1', 'fw_2', 'fw_3'), false) AS has_template,
    length(designed_sequence) + seed % 300 AS tokens, candidate_index % 10 / 10.0 AS iptm, candidate_index AS k
    FROM v_candidates JOIN v_shards USING (shard_id))"""


@query(
    "b15_validation_skip_reason",
    f"""WITH {_PLANNED} SELECT candidate_id, CASE
      WHEN scaffold = 'scfv' AND NOT has_template THEN 'scFv validation requires a bundled framework template'
      WHEN tokens > 200 THEN 'validation input has ' || tokens || ' tokens, exceeding limit 200' END AS skip_reason FROM p""",
)
def b15(c):
    p = _planned(c)
    return p.select("candidate_id", G.validation_skip_reason(p, 200).alias("skip_reason"))


@query(
    "b16_prefetch_decision",
    f"""WITH {_PLANNED} SELECT candidate_id, CASE WHEN iptm < 0.3 THEN 'design below prefetch threshold 0.3; no MSA queued'
      WHEN NOT coalesce(CASE WHEN k % 3 = 0 THEN k % 2 = 0 END, k % 5 - 2 > 0) THEN 'design failed hotspot prefetch filter; no MSA queued'
      WHEN scaffold = 'scfv' AND NOT has_template THEN 'scFv validation requires a bundled framework template; no MSA queued'
      ELSE 'queue' END AS decision FROM p""",
)
def b16(c):
    return G.prefetch_decision(_planned(c), 0.3, "always").select("candidate_id", "decision")


@query(
    "b19_heavy_atoms",
    """SELECT l_orderkey, l_linenumber, l_partkey, name FROM (SELECT l_orderkey, l_linenumber, l_partkey, p_name AS name,
         upper(substr(p_type, 1, 1)) AS element FROM lineitem JOIN part ON p_partkey = l_partkey)
       WHERE element NOT IN ('H', 'D') AND upper(name) NOT LIKE 'H%'""",
)
def b19(c):
    from bindscope.operators.structure import heavy_atoms

    atoms = c.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(
        c.part.select("p_partkey", F.col("p_name").alias("name"), F.substring("p_type", 1, 1).alias("element")),
        F.col("l_partkey") == F.col("p_partkey"),
    )
    return heavy_atoms(atoms, "element", "name").select("l_orderkey", "l_linenumber", "l_partkey", "name")


@query(
    "b20_safe_artifact_path",
    """WITH p AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '/' WHEN 1 THEN '../' WHEN 2 THEN 'a/../../' ELSE 'a/b/../' END || regexp_replace(url, '^https?://', '') AS path FROM pages)
       SELECT page_id, page_id % 5 IN (3, 4) AS valid FROM p""",
)
def b20(c):
    head = (
        F.when(F.col("page_id") % 5 == 0, "/").when(F.col("page_id") % 5 == 1, "../")
        .when(F.col("page_id") % 5 == 2, "a/../../").otherwise("a/b/../")
    )
    path = F.concat(head, F.regexp_replace("url", "^https?://", ""))
    return c.pages.select("page_id", G.valid_relpath(path).alias("valid"))


@query(
    "b21_hotspot_distance",
    "SELECT candidate_id, critic_name, nullif(metrics_json, '') ->> '$.hotspot_min_heavy_atom_distance_min' AS distance FROM v_critic",
)
def b21(c):
    d = c.v_critic.withColumn("d", S.decode_metrics("metrics_json", "candidate_id"))
    return d.select("candidate_id", "critic_name", G.hotspot_distance("d").alias("distance"))
