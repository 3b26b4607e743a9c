"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from bindscope.catalog import load
from bindscope.session import local_session

HEADLINE = [
    "b1_metric_rows", "b14_ranking_eligibility", "c1_completed_metrics", "c5_ready_tasks", "c8_reconcile", "d1_status_counts",
    "d7_campaign_state", "d19_score_hotspots", "d22_distance_rmse", "d27_iptm_d0chn", "d28_ipsae_asymmetric", "d29_pdockq", "d31_lis",
    "d33_pair_summary", "d36_score_correlation", "d40_contact_probability", "d44_distogram_proxy", "d45_contact_loss",
    "e1_dedup_best_by_sequence", "e2_select_designs", "e4_validation_rank", "e6_best_sample", "e9_final_rank", "e10_pareto_fronts",
    "g3_upsert_critics", "i2_sweep_stale", "k3_check_foreign_key",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_orderkey").count().write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "campaign_analytics_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(sf.group(1)) if sf else folder,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
