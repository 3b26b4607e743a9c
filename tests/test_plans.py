"""Plan shapes: no cartesian joins, pruned scans, no single-task ranking."""

from __future__ import annotations

import re

import pytest

from bindscope.catalog import load

FOLDER = "/root/testdata/sf0.001"
CHECKED = [
    "b1_metric_rows", "c5_ready_tasks", "c8_reconcile", "c10_priority_lookup", "c16_distogram", "d15_scoped_pair_metric", "d19_score_hotspots",
    "d22_distance_rmse", "d28_ipsae_asymmetric", "d33_pair_summary", "d45_contact_loss", "e1_dedup_best_by_sequence", "e2_select_designs",
    "e4_validation_rank", "e9_final_rank", "g3_upsert_critics", "i3_sweep_workers", "b17_select_residues", "k7_check_pair_mask",
]


def plan(spark, name):
    df = load()[0][name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_no_cartesian_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(spark, "e6_best_sample")
    assert "l_extendedprice" not in text and "l_returnflag" not in text


def test_dedup_limits_before_the_shuffle(spark):
    text = plan(spark, "e1_dedup_best_by_sequence")
    assert text.count("WindowGroupLimit") == 2


def nodes(plan):
    """All nodes that ran, those of stages and subqueries too."""
    each = lambda s: [s.apply(i) for i in range(s.size())]
    kind = plan.getClass().getSimpleName()
    yield plan
    below = each(plan.children()) + each(plan.subqueries())
    below += [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else []
    for child in below:
        yield from nodes(child)


def exchanges(df, of=""):
    """Exchanges that ran, without those that read the result of another."""
    df.collect()
    names = [n.simpleString(100) for n in nodes(df._jdf.queryExecution().executedPlan())]
    return sum(n.startswith("Exchange ") and of in n for n in names)


RANKED = {"e3_plan_selection": 1, "e4_validation_rank": 1, "e5_order_samples": 1, "e8_validator_rank": 1, "e9_final_rank": 1, "e11_compact_ranking": 1,
          "f1_multi_key_order": 1, "f5_issue_order": 1, "f3_top_summaries": 0, "d36_score_correlation": 2}


@pytest.mark.parametrize("name", RANKED)
def test_ranked_rows_are_exchanged_once(spark, name):
    """One exchange per rank, which its counts read too; nothing is stored before it."""
    df = load()[0][name](spark, FOLDER)
    assert exchanges(df, "(__slot#") == RANKED[name]
    assert "Scan ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()


ERRORS = ["d27_iptm_d0chn", "d28_ipsae_by_residue", "d28_ipsae_asymmetric", "d31_lis", "d32_interface_counts", "d33_pair_summary", "d34_scope_ipsae"]


@pytest.mark.parametrize("name", ERRORS)
def test_pair_rows_are_never_exchanged(spark, name):
    """What is exchanged of the error matrix: scores of residues, words of bitmaps, or rows of
    the matrix. No row of one pair (i, j, error), and rows of the matrix not without need."""
    df = load()[0][name](spark, FOLDER)
    df.collect()
    for node in nodes(df._jdf.queryExecution().executedPlan()):
        if node.nodeName() == "Exchange":
            names = {f.name() for f in (node.schema().apply(i) for i in range(node.schema().size()))}
            assert not {"i", "j", "pae"} <= names and not ({"errors", "paes"} & names and name in ("d27_iptm_d0chn", "d31_lis"))


@pytest.mark.parametrize("name", ["e4_validation_rank", "e9_final_rank", "f1_multi_key_order"])
def test_ranking_never_uses_one_partition(spark, name):
    text = plan(spark, name)
    head = text.split("Subquery")[0]
    assert "Exchange SinglePartition" not in head


def test_selectors_are_never_broadcast(spark):
    """Exploded selectors look small to the planner; residues meet them in one shuffled join."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    held = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "10MB")
        df = load()[0]["b17_select_residues"](spark, FOLDER)
        df.collect()
        names = [n.nodeName() for n in nodes(df._jdf.queryExecution().executedPlan())]
        assert names.count("SortMergeJoin") == 2 and not any("Broadcast" in x for x in names)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["d29_pdockq", "d30_pdockq2", "d32_interface_counts", "d33_pair_summary"])
def test_copies_of_atoms_are_never_broadcast(spark, name):
    """Exploded copies look small to the planner; with Spark's own threshold they went through the driver."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    held = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "10MB")
        df = load()[0][name](spark, FOLDER)
        df.collect()
        all_nodes = list(nodes(df._jdf.queryExecution().executedPlan()))
        copies = [n.simpleString(200) for n in all_nodes if "Join" in n.nodeName() and "cx#" in n.simpleString(200)]
        assert copies and all(n.startswith("SortMergeJoin") for n in copies)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["h10_template_panel", "h10_best_source"])
def test_panel_is_matched_once(spark, name):
    """Matches are found once, by tasks dealt from few files, and patterns run behind the order of their literals."""
    text = plan(spark, name)
    assert text.count("supplier.parquet") == 1 and text.count("locate") >= 1 and "RoundRobinPartitioning" in text


def test_siblings_meet_in_one_exchange(spark):
    from bindscope.sources import tables

    names = ["x_summary_confidence_sample_1.json", "x_full_data_sample_01.json", "x_sample_1.cif", "y_summary_confidence_sample_1.json", "z_sample_2.cif"]
    paths = [(f"out/seed_7/p/{n}",) for n in names] + [("w_summary_confidence_sample_3.json",), ("w_sample_3.cif",), (None,)]
    out = tables.pair_outputs(spark.createDataFrame(paths, "path string"))
    got = sorted((r.seed or 0, r.sample_rank, r.stem, r.full, r.cif) for r in out.collect())
    assert got == [(0, 3, "w", None, "w_sample_3.cif"), (7, 1, "x", "out/seed_7/p/x_full_data_sample_01.json", "out/seed_7/p/x_sample_1.cif")]
    text = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert text.count("Exchange hashpartitioning") == 1


def test_campaign_state_works_out_issues_once(spark):
    assert len(re.findall(r"Join \[path#\d+\], \[path#\d+\]", plan(spark, "d7_campaign_state"))) == 1


def test_source_critic_packs_only_what_a_report_uses(spark):
    assert "metrics_json" not in plan(spark, "c3_task_report")


def test_files_of_a_design_are_looked_for_by_one_join(spark):
    text = load()[0]["a19_paired_topk_manifest"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join LeftSemi") == 1


def test_campaign_summary_works_out_metric_rows_once(spark):
    """They were worked out for the counts and for the top rows; both now read the stored rows."""
    text = plan(spark, "d11_campaign_summary")
    assert "metrics_json" not in text and "__k0:double" in text
