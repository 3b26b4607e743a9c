"""SQL pieces shared by several checks, and their DataFrame twins."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bindscope.operators import gating as G
from bindscope.operators import ledger as L
from bindscope.plans.views import Campaign

SRC = """src AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY critic_name) AS rn
    FROM v_critic WHERE status = 'completed') WHERE rn = 1)"""

TASKS = (
    SRC
    + """, rr AS (SELECT t.validation_id, t.candidate_id, t.model_name, t.validation_config_hash, t.selection_rank,
    t.status AS validator_status, t.validator_passed, t.iptm AS validator_iptm, t.ipsae AS validator_ipsae,
    t.ranking_score AS validator_ranking_score, t.rmsd, t.output_structure_path AS validated_structure_path,
    c.designed_sequence, c.framework, c.binder_scaffold, h.seed, s.critic_name AS source_critic,
    s.iptm AS critic_iptm, s.structure_path AS source_structure_path
    FROM v_tasks t JOIN v_candidates c USING (candidate_id) JOIN v_shards h USING (shard_id)
    LEFT JOIN src s USING (candidate_id))"""
)

PASSED = """coalesce(CASE lower(trim(validator_passed)) WHEN 'true' THEN true WHEN '1' THEN true WHEN 'yes' THEN true
    WHEN 'false' THEN false WHEN '0' THEN false WHEN 'no' THEN false END,
    instr('/' || coalesce(validated_structure_path, ''), '/passing/') > 0)"""
UNIT = "CASE WHEN {0} BETWEEN 0 AND 1 THEN {0} END"

SCORED = (
    TASKS
    + f""", sc AS (SELECT *, sqrt(ci * ev) AS confidence_score, exp(-0.5 * pow(rmsd / 2.5, 2)) AS agreement_score
    FROM (SELECT *, CASE WHEN validator_ipsae IS NULL THEN vi ELSE sqrt(vi * vs) END AS ev,
          validator_status = 'completed' AND {PASSED} AND ci IS NOT NULL AND vi IS NOT NULL
            AND (validator_ipsae IS NULL OR vs IS NOT NULL) AND rmsd IS NOT NULL AND rmsd <= 2.5 AS ranking_eligible
          FROM (SELECT *, {UNIT.format('critic_iptm')} AS ci, {UNIT.format('validator_iptm')} AS vi,
                {UNIT.format('validator_ipsae')} AS vs FROM rr)))"""
)

METRICS = """cm AS (SELECT c.candidate_id, s.seed, c.designed_sequence, c.binder_scaffold AS scaffold,
    CASE c.binder_scaffold WHEN 'miniprotein' THEN 'mp' ELSE c.binder_scaffold END AS binder_type,
    m.critic_name, m.iptm, m.distogram_iptm_proxy, m.cdr_distogram_iptm_proxy,
    cast(nullif(m.metrics_json, '') ->> '$.hotspot_min_heavy_atom_distance_min' AS double) AS hd,
    cast(nullif(m.metrics_json, '') ->> '$.hotspot_contact_cutoff_angstrom' AS double) AS hc,
    m.structure_path, c.design_metrics_json, m.metrics_json, m.hotspot_satisfaction, c.framework,
    m.ptm, m.plddt, c.binder_chain_id, c.sequence_path
    FROM v_candidates c JOIN v_shards s USING (shard_id) JOIN v_critic m USING (candidate_id)
    WHERE c.status = 'completed' AND m.status = 'completed')"""


def task_rows(c: Campaign) -> DataFrame:
    return L.task_rows(c.v_tasks, c.v_candidates, c.v_shards, c.v_critic)


def scored_rows(c: Campaign, cfg: G.RankingConfig | None = None) -> DataFrame:
    cfg = cfg or G.RankingConfig()
    return G.consensus_score(G.ranking_eligibility(task_rows(c), cfg), cfg)


def completed(c: Campaign) -> DataFrame:
    return L.completed_metrics(c.v_candidates, c.v_shards, c.v_critic)


def metric_rows(c: Campaign) -> DataFrame:
    return G.metric_rows(completed(c))
