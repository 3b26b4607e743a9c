"""Ranks, gates, scores and fronts on hand-computed cases."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bindscope.operators import gating as G
from bindscope.operators import pareto as P
from bindscope.operators import ranking as R
from bindscope.operators import selection as X

SCHEMA = (
    "validation_id string, candidate_id string, validator_status string, validator_passed string, critic_iptm double, "
    "validator_iptm double, validator_ipsae double, rmsd double, selection_rank bigint, validated_structure_path string"
)


def rows(spark, data):
    return spark.createDataFrame([(f"v{i}", n, "completed", "true", c, v, s, r, i + 1, "") for i, (n, c, v, s, r) in enumerate(data)], SCHEMA)


def scored(spark, data, **cfg):
    conf = G.RankingConfig(**cfg)
    return G.consensus_score(G.ranking_eligibility(rows(spark, data), conf), conf)


def test_consensus_ranking(spark):
    df = scored(spark, [("close", 0.8, 0.9, 0.8, 1.0), ("near", 0.8, 0.9, 0.8, 2.4), ("over", 0.9, 0.95, 0.9, 2.6)])
    out = {r.candidate_id: r for r in X.validator_rank(X.final_rank(df)).collect()}
    assert [out[n].ranking_eligible for n in ("close", "near", "over")] == [True, True, False]
    assert [out[n].final_rank for n in ("close", "near", "over")] == [1, 2, None]
    assert [out[n].validator_rank for n in ("close", "near", "over")] == [2, 3, 1]
    assert out["over"].ranking_exclusion_reason == "binder CA RMSD 2.600 exceeds 2.500 angstrom"
    assert out["close"].final_score == pytest.approx(math.sqrt(0.8 * math.sqrt(0.9 * 0.8)))


def test_rmsd_weight(spark):
    row = scored(spark, [("a", 0.8, 0.9, None, 1.0)], rmsd_weight=0.25).first()
    assert row.evaluator_score == 0.9 and row.metric_basis == "critic_iptm+validator_iptm"
    confidence, agreement = math.sqrt(0.8 * 0.9), math.exp(-0.5 * (1.0 / 2.5) ** 2)
    assert row.final_score == pytest.approx(confidence**0.75 * agreement**0.25)


def test_invalid_ipsae_has_no_score(spark):
    row = scored(spark, [("a", 0.8, 0.9, 1.5, 1.0)]).first()
    assert row.final_score is None and row.ranking_exclusion_reason == "invalid validator ipSAE"


@pytest.mark.parametrize("weight", [-0.1, 1.0])
def test_config_rejects_weight(weight):
    with pytest.raises(ValueError):
        G.RankingConfig(rmsd_weight=weight)


def test_pareto_case(spark):
    pts = spark.createDataFrame([("a", 0.9, 0.8), ("b", 0.8, 0.9), ("c", 0.8, 0.8), ("d", 0.7, 0.7), ("e", 0.9, 0.8)], "id string, x double, y double")
    out = {r.id: r.pareto_front for r in P.pareto_fronts(pts, "x", "y").collect()}
    assert out == {"a": 1, "b": 1, "c": 2, "d": 3, "e": 1}


def brute_fronts(points):
    left, out, front = set(points), {}, 0
    while left:
        front += 1
        layer = {p for p in left if not any(q != p and q[0] >= p[0] and q[1] >= p[1] for q in left)}
        out.update({p: front for p in layer})
        left -= layer
    return out


def test_pareto_matches_peeling_definition():
    rng = random.Random(7)
    for _ in range(200):
        pts = {(rng.randint(0, 6), rng.randint(0, 6)) for _ in range(rng.randint(1, 25))}
        order = np.array(sorted(pts, key=lambda p: (-p[0], -p[1])), dtype=float)
        got = P.layer_numbers(order[:, 0], order[:, 1])
        assert dict(zip(map(tuple, order.astype(int).tolist()), got.tolist())) == brute_fronts(pts)


def in_grid(points, block, rng):
    """Fronts by cells as the rounds build them, with plain lists."""
    by_x, by_y = (sorted(points, key=k) for k in (lambda p: (-p[0], -p[1]), lambda p: (-p[1], -p[0])))
    cells = {}
    for p in points:
        cells.setdefault((by_x.index(p) // block, by_y.index(p) // block), []).append(p)
    rows, columns, tops, out = {}, {}, {}, {}
    for i, j in sorted(cells, key=lambda c: (sum(c), rng.random())):
        own = np.array(sorted(cells[i, j], key=lambda p: (-p[0], -p[1])), dtype=float)
        row, column = rows.setdefault(j, P.Stairs([], [])), columns.setdefault(i, P.Stairs([], []))
        corner = max((t for (a, b), t in tops.items() if a < i and b < j), default=0)
        found = P.cell_fronts(own[:, 0], own[:, 1], row, column, corner)
        columns[i] = P.Stairs(column.fronts + found.tolist(), [-v for v in column.negative] + own[:, 0].tolist())
        tops[i, j] = int(found.max())
        out.update(zip(map(tuple, own.astype(int).tolist()), found.tolist()))
    return out


def test_grid_of_cells_gives_the_same_fronts():
    rng = random.Random(9)
    for size in (3, 8, 40):
        for _ in range(60):
            pts = {(rng.randint(0, size), rng.randint(0, size)) for _ in range(rng.randint(1, 70))}
            assert in_grid(pts, rng.choice([1, 2, 5, 13]), rng) == brute_fronts(pts)


def test_large_group_is_layered_in_rounds(spark):
    """Two groups beyond a cell, one within; ties, nulls, NaN and an ineligible row."""
    rng = random.Random(3)
    pts = [(g, rng.randint(0, 12) / 10, rng.randint(0, 12) / 10, True) for g in ("m", None) for _ in range(60)]
    pts += [("small", 0.1, 0.2, True), ("small", None, 0.2, True), ("small", 0.3, float("nan"), True), ("small", 9.0, 9.0, False), ("small", 9.0, 9.0, None)]
    df = spark.createDataFrame(pts, "g string, x double, y double, ok boolean")
    got = P.pareto_fronts(df, "x", "y", ["g"], eligible="ok", block=25)
    assert got.columns == ["g", "x", "y", "ok", "pareto_front"]
    want = {g: brute_fronts({p[1:3] for p in pts if p[0] == g}) for g in ("m", None)}
    rows = got.collect()
    assert len(rows) == len(pts)
    assert all(r.pareto_front == want[r.g][r.x, r.y] for r in rows if r.g != "small")
    assert [r.pareto_front for r in rows if r.g == "small" and r.x == 0.1] == [1]
    assert all(r.pareto_front is None for r in rows if r.g == "small" and r.x != 0.1)
    whole = P.pareto_fronts(df, "x", "y", ["g"], eligible="ok")
    assert sorted(map(str, whole.collect())) == sorted(map(str, rows))


def test_long_chain_takes_few_rounds(spark):
    """A front per point: as many fronts as points, yet five rounds."""
    df = spark.range(120_000).select(F.col("id"), (F.col("id") * 0.5).alias("x"), (F.col("id") * 0.25).alias("y"))
    out = P.pareto_fronts(df, "x", "y", block=40_000)
    assert out.filter(F.col("pareto_front") == 120_000 - F.col("id")).count() == 120_000


def test_add_rank_equals_window_under_skew(spark):
    """A third of the rows share one score and most rows one group."""
    df = spark.range(20000).select(
        "id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.pmod(F.hash("id"), F.lit(97)) / 97.0).alias("score"),
        F.when(F.col("id") % 10 == 0, "small").otherwise("big").alias("g"),
    ).withColumn("score", F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("score")))
    keys = [R.high_first("score"), F.col("id")]
    for by, buckets in ((["g"], 8), ([], 7), (["g"], 1)):
        w = Window.partitionBy(*by).orderBy(*keys) if by else Window.orderBy(*keys)
        out = R.add_rank(df, keys, "rk", by=by, buckets=buckets).withColumn("want", F.row_number().over(w))
        assert out.filter("rk <> want or rk is null").count() == 0
        assert out.count() == 20000


def test_add_rank_with_many_groups_nulls_and_maps(spark):
    """Groups inside buckets, across buckets, null and empty names; a map column is kept."""
    df = spark.range(5000).select(
        "id", F.when(F.col("id") % 5 == 0, F.lit(None)).when(F.col("id") % 5 == 1, "").otherwise(F.concat(F.lit("g"), (F.col("id") % 700).cast("string"))).alias("g"),
        (F.col("id") % 3 == 0).alias("h"), F.create_map(F.lit("a"), F.col("id")).alias("m"),
    )
    keys = [F.pmod(F.hash("id"), F.lit(11)), F.col("id")]
    out = R.add_rank(df, keys, "rk", by=["g", "h"], buckets=16)
    assert out.columns == ["id", "g", "h", "m", "rk"]
    w = Window.partitionBy("g", "h").orderBy(*keys)
    assert out.withColumn("want", F.row_number().over(w)).filter("rk = want and m['a'] = id").count() == 5000
    assert R.add_rank(df.limit(0), keys, "rk", by=["g"]).count() == 0
    assert [r.rk for r in R.add_rank(df.limit(1), keys, "rk").collect()] == [1]


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame([("s1", 0.5, "b"), ("s1", 0.7, "a"), ("s2", None, "c")], "seq string, iptm double, name string")
    keys = [R.high_first("iptm"), R.text_first("name")]
    once = R.dedup_best(df, "seq", keys)
    assert sorted(once.collect()) == sorted(R.dedup_best(once, "seq", keys).collect())
    assert {r.seq: r.name for r in once.collect()} == {"s1": "a", "s2": "c"}


def test_hotspot_gate_modes(spark):
    schema = "n string, iptm double, hotspot_distance_angstrom double, hotspot_cutoff double"
    df = spark.createDataFrame([("hit", 0.5, 3.0, 5.0), ("miss", 0.9, 9.0, 5.0), ("none", 0.8, None, None)], schema)
    names = lambda d: {r.n for r in d.collect()}
    assert names(G.hotspot_gate(df, "auto")) == {"hit"}
    assert names(G.hotspot_gate(df, "never")) == {"hit", "miss", "none"}
    bare = df.filter("n = 'none'")
    assert names(G.hotspot_gate(bare, "auto")) == {"none"}
    assert names(G.hotspot_gate(bare, "auto", configured=True)) == set()


def test_top_n_must_be_positive(spark):
    with pytest.raises(ValueError):
        R.top_n(spark.range(3), [F.col("id")], 0)


def test_best_sample_prefers_passing(spark):
    schema = "validation_id string, structure_id string, status string, scoped_iptm double, scoped_ipsae double, ranking_score double, sample_rank bigint, seed bigint"
    df = spark.createDataFrame([("v", "a", "rejected", 0.9, 0.1, 0.9, 0, 1), ("v", "b", "passing", 0.7, 0.6, 0.1, 1, 1)], schema)
    assert X.best_sample(df).first().structure_id == "b"


def test_correlation_is_null_without_spread(spark):
    df = spark.createDataFrame([("a", 0.5, 0.1), ("b", 0.5, 0.2)], "id string, x double, y double")
    row = X.score_correlation(df, "x", "y", "id").first()
    assert (row.n, row.pearson, row.spearman) == (2, None, None)


def test_analysis_report_takes_copied_designs_as_flag(spark):
    said = [("a", "f", "m", "bad", True, 1.0, True), ("b", "f", "", None, True, None, False), ("c", "f", "m", "", False, 2.0, True), ("d", None, "n", "bad", True, None, None)]
    rows = spark.createDataFrame(
        [(*r[:5], r[5], "true" if r[0] == "a" else "no", r[6]) for r in said],
        "validation_id string, framework string, model_name string, pose_error string, ranking_eligible boolean, rmsd double, validator_passed string, flag boolean",
    )
    listed = X.analysis_report(rows, rows.filter("flag").select("validation_id"), 84, ["framework"])
    got = {r.framework: r for r in X.analysis_report(rows, F.col("flag"), 84, ["framework"]).collect()}
    assert got == {r.framework: r for r in listed.collect()}
    f, none = got["f"], got[None]
    assert (f.ranked_designs, f.diagnostic_rows, f.validator_pass_count, f.copied_designs, f.rows_with_binder_ca_rmsd, f.top_k) == (2, 3, 1, 1, 2, 84)
    assert (f.validator_models, f.pose_errors, none.validator_models, none.pose_errors) == ({"m": 2, "unknown": 1}, {"bad": 1}, {"n": 1}, {"bad": 1})
    (every,) = X.analysis_report(rows, F.col("flag"), 84).collect()
    assert (every.diagnostic_rows, every.copied_designs, every.validator_models, every.pose_errors) == (4, 1, {"m": 2, "n": 1, "unknown": 1}, {"bad": 2})
