"""The path from the ledger's declared schema to a shortlist and a ranking."""

from __future__ import annotations

import threading

from bindscope.operators import gating, ledger, selection
from bindscope.sources import ledger as LED
from bindscope.sources.ledger import COLUMNS, conform, schema


def test_declared_schema(spark):
    t = {name: spark.createDataFrame([], schema(name)) for name in COLUMNS}
    rows = {
        "shards": [("s1", 7)], "candidates": [("c1", "s1", "ACD", "completed", '{"framework_name":"fw","binder_scaffold":" VHH "}')],
        "critic_metrics": [("c1", "k1", "completed", 0.8, '{"cdr_distogram_iptm_proxy":0.25}')],
        "validation_tasks": [("v1", "c1", "m", "completed", 0.7, '{"validation_passed":true}')],
    }
    columns = {
        "shards": "shard_id string, seed long",
        "candidates": "candidate_id string, shard_id string, designed_sequence string, status string, design_metrics_json string",
        "critic_metrics": "candidate_id string, critic_name string, status string, iptm double, metrics_json string",
        "validation_tasks": "validation_id string, candidate_id string, model_name string, status string, iptm double, metrics_json string",
    }
    for name, held in rows.items():
        t[name] = conform(spark.createDataFrame(held, columns[name]), name)
    metrics = gating.metric_rows(ledger.completed_metrics(t["candidates"], t["shards"], t["critic_metrics"]))
    short = selection.select_designs(metrics, max_n=100, min_iptm=0.3, gate="auto").collect()
    assert [(r.candidate_id, r.cdr_distogram_iptm_proxy, r.framework) for r in short] == [("c1", 0.25, "fw")]
    poses = spark.createDataFrame([("v1", 1.5)], "validation_id string, rmsd double")
    tables = t["validation_tasks"], t["candidates"], t["shards"], t["critic_metrics"]
    (got,) = ledger.task_rows(*tables, poses).collect()
    assert (got.validator_passed, got.rmsd, got.framework, got.binder_scaffold, got.critic_iptm) == ("true", 1.5, "fw", "vhh", 0.8)
    assert ledger.pose_summary(ledger.task_rows(*tables)).first().rows_missing_binder_ca_rmsd == 1
    issues = spark.createDataFrame([], "kind string")
    assert ledger.validation_summary(t["validation_tasks"], t["validation_structures"], issues).first().completed_task_pass_count == 1


def test_tables_are_written_side_by_side(spark, tmp_path, monkeypatch):
    meet, plain = threading.Barrier(2), LED.conform

    def conform(df, name):
        meet.wait(20)
        return plain(df, name)

    monkeypatch.setattr(LED, "conform", conform)
    held = {"candidates": spark.createDataFrame([("x",)], "candidate_id string"), "shards": spark.createDataFrame([("a",), ("b",)], "shard_id string")}
    LED.write_ledger(held, str(tmp_path))
    assert {t: df.count() for t, df in LED.read_ledger(spark, str(tmp_path), list(held)).items()} == {"candidates": 1, "shards": 2}
    LED.write_ledger({}, str(tmp_path))
