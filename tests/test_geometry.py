"""Geometry and interface scores against NumPy and hand-made cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bindscope.operators import distogram as D
from bindscope.operators import geometry as G
from bindscope.operators import interface as I


def reference_rmsd(m, f):
    m, f = m - m.mean(0), f - f.mean(0)
    u, _, vt = np.linalg.svd(m.T @ f)
    r = u @ np.diag([1, 1, np.sign(np.linalg.det(u @ vt))]) @ vt
    return math.sqrt(((m @ r - f) ** 2).sum(1).mean())


def pairs(spark, m, f):
    return spark.createDataFrame([(1, *map(float, a), *map(float, b)) for a, b in zip(m, f)], "g bigint, mx double, my double, mz double, fx double, fy double, fz double")


def rotation():
    a, b = 0.7, -1.1
    z = np.array([[math.cos(a), -math.sin(a), 0], [math.sin(a), math.cos(a), 0], [0, 0, 1]])
    x = np.array([[1, 0, 0], [0, math.cos(b), -math.sin(b)], [0, math.sin(b), math.cos(b)]])
    return z @ x


def test_rmsd_is_zero_under_rigid_motion(spark):
    f = np.random.default_rng(0).normal(size=(12, 3)) * 10
    got = G.aligned_rmsd(pairs(spark, f @ rotation() + [3, -5, 9], f), ["g"]).first()
    assert got.aligned_rmsd == pytest.approx(0, abs=1e-9) and got.residue_count == 12


def test_rmsd_with_reflection(spark):
    f = np.random.default_rng(1).normal(size=(9, 3)) * 5
    m = f * [1, 1, -1] + np.random.default_rng(2).normal(size=(9, 3))
    assert G.aligned_rmsd(pairs(spark, m, f), ["g"]).first().aligned_rmsd == pytest.approx(reference_rmsd(m, f), abs=1e-9)


def test_rmsd_of_any_point_sets(spark):
    """Random, mirrored, flat, on a line, in one place, two points, turned by half a circle; large and small scales."""
    rng = np.random.default_rng(5)
    half = np.diag([1.0, -1.0, -1.0])
    sets = []
    for scale in (1e-3, 1.0, 1e4):
        f = rng.normal(size=(8, 3)) * scale
        line = np.outer(np.arange(6), [1.0, 2.0, -1.0]) * scale
        sets += [(rng.normal(size=(8, 3)) * scale, f), (f * [1, 1, -1], f), (f * [1, 1, 0], f), (line @ rotation(), line), (line[::-1] * 1.5, line),
                 (f @ half, f), (f @ half @ rotation(), f), (f[:2], f[2:4]), (np.ones((3, 3)) * scale, np.zeros((3, 3))), (f, f), (-f, f)]
    rows = [(g, *map(float, a), *map(float, b)) for g, (m, f) in enumerate(sets) for a, b in zip(m, f)]
    df = spark.createDataFrame(rows, "g bigint, mx double, my double, mz double, fx double, fy double, fz double")
    got = {r.g: r.aligned_rmsd for r in G.aligned_rmsd(df, ["g"]).collect()}
    for g, (m, f) in enumerate(sets):
        size = np.abs(f).max() + np.abs(m).max()
        assert got[g] == pytest.approx(reference_rmsd(m, f), abs=1e-10 * size), g
    turns = [np.array(r.rot).reshape(3, 3) for r in G.superposition(df, ["g"], 2).collect()]
    assert all(np.abs(t @ t.T - np.eye(3)).max() < 1e-12 and np.linalg.det(t) > 0 for t in turns)


def test_pose_agreement(spark):
    rng = np.random.default_rng(4)
    target, binder = rng.normal(size=(6, 3)) * 8, rng.normal(size=(5, 3)) * 4
    move = lambda p: p @ rotation() + [1, 2, 3]
    shifted = binder + [0, 0, 2.0]
    b = pairs(spark, move(shifted), binder).withColumn("is_ca", F.lit(True))
    ids = spark.createDataFrame([(1,), (2,)], "g bigint")
    out = {r.g: r for r in G.pose_agreement(pairs(spark, move(target), target), b, ids, "g").collect()}
    assert out[1].target_aligned_rmsd == pytest.approx(0, abs=1e-9)
    assert out[1].binder_ca_rmsd == pytest.approx(2.0) and out[1].binder_centroid_distance == pytest.approx(2.0)
    assert out[2].pose_error == "could not match target chains"
    few = G.pose_agreement(pairs(spark, target[:2], target[:2]), b, ids.filter("g = 1"), "g").first()
    assert few.pose_error == "insufficient matched target CA atoms" and few.binder_ca_rmsd is None


def atoms(spark, seed=0, n=60):
    rng = np.random.default_rng(seed)
    xyz = rng.uniform(-15, 15, size=(n, 3))
    return xyz, spark.createDataFrame([(1, "A" if i < n // 2 else "B", i, *map(float, p)) for i, p in enumerate(xyz)], "structure_id bigint, chain string, residue bigint, x double, y double, z double")


def test_contact_pairs_match_brute_force(spark):
    xyz, df = atoms(spark)
    got = {(r.i, r.j) for r in G.contact_pairs(df, 8.0).collect()}
    want = {(i, j) for i in range(60) for j in range(60) if (i < 30) != (j < 30) and np.linalg.norm(xyz[i] - xyz[j]) <= 8.0}
    assert got == want


def test_hotspots(spark):
    rows = [(1, "A", 0, 3.2, 0.0, 0.0), (1, "A", 1, 12.0, 0.0, 0.0), (1, "B", 0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "structure_id bigint, chain string, residue bigint, x double, y double, z double")
    spots = spark.createDataFrame([(1, "A", 0), (1, "A", 7)], "structure_id bigint, chain string, residue bigint")
    row = G.score_hotspots(df, spots, F.col("chain") == "B", 5.0).first()
    assert row.hotspot_pass and row.hotspot_distance == pytest.approx(3.2) and row.missing_residues == "A:8"
    far = G.score_hotspots(df, spots.filter("residue = 0").withColumn("residue", F.lit(1).cast("bigint")), F.col("chain") == "B", 5.0).first()
    assert far.hotspot_fail_reason == "validation hotspot distance 12.0000 exceeds cutoff 5.0000"
    none = G.score_hotspots(df.filter("chain = 'A'"), spots, F.col("chain") == "B", 5.0).first()
    assert none.hotspot_fail_reason == "no binder heavy atoms found"


def test_match_chains_greedy(spark):
    schema = "k bigint, chain string, chain_order int, sequence string"
    src = spark.createDataFrame([(1, "A", 0, "AAAA"), (1, "B", 1, "CCCCCC"), (1, "C", 2, "DD")], schema)
    dst = spark.createDataFrame([(1, "X", 0, "CCCCCC"), (1, "Y", 1, "EEEEE")], schema)
    assert sorted((r.src_chain, r.dst_chain) for r in G.match_chains(src, dst, "k").collect()) == [("A", "Y"), ("B", "X")]


def reference_ipsae(pae, chains, cut):
    def d0(n):
        return max(1.0, 1.24 * (max(n, 27) - 15) ** (1 / 3) - 1.8)

    out = {}
    for a in np.unique(chains):
        for b in np.unique(chains):
            if a == b:
                continue
            best = 0.0
            for i in np.where(chains == a)[0]:
                ok = (chains == b) & (pae[i] < cut)
                if ok.any():
                    best = max(best, float((1 / (1 + (pae[i][ok] / d0(ok.sum())) ** 2)).mean()))
            out[(a, b)] = best
    return out


def test_ipsae_three_chains(spark):
    rng = np.random.default_rng(9)
    chains = np.array(list("A" * 40 + "B" * 33 + "C" * 8))
    pae = rng.uniform(0, 30, size=(81, 81))
    pae[:40, 73:] = 29.0
    rows = [(1, i, j, chains[i], chains[j], float(pae[i, j])) for i in range(81) for j in range(81) if chains[i] != chains[j]]
    df = spark.createDataFrame([tuple(map(lambda v: v.item() if hasattr(v, "item") else v, r)) for r in rows], "structure_id bigint, i bigint, j bigint, chain_i string, chain_j string, pae double")
    got = {(r.chain_i, r.chain_j): r for r in I.asym_scores(I.by_residue(I.rows_of_pairs(df), 15.0)).collect()}
    want = reference_ipsae(pae, chains, 15.0)
    assert set(got) == set(want)
    for pair, value in want.items():
        assert got[pair].ipsae == pytest.approx(value, abs=1e-12) and got[pair].ipsae <= 1
    assert got[("A", "C")].ipsae == 0.0 and got[("A", "C")].ipsae_residue is None
    assert got[("A", "B")].n0chn == 73


def test_scope_takes_best_pair(spark):
    asym = spark.createDataFrame([(1, "A", "B", 0.73), (1, "B", "A", 0.35), (1, "B", "C", 0.2), (1, "C", "B", 0.1), (1, "A", "C", 0.99), (1, "C", "A", 0.9)], "structure_id bigint, chain_i string, chain_j string, ipsae double")
    roles = spark.createDataFrame([(1, "A", "target"), (1, "C", "target"), (1, "B", "binder")], "structure_id bigint, chain string, role string")
    row = I.scope_ipsae(asym, roles).first()
    assert (row.value, row.ipsae_min, row.ipsae_max, row.best_pair, row.pairs) == (0.73, 0.1, 0.73, "A-B", 2)


def test_matrix_rows_with_gaps_bitmaps_and_nulls(spark):
    """Chains of 150 and 70 residues (several words of a bitmap), a gap in the numbers, a missing pair."""
    rng = np.random.default_rng(2)
    numbers = {"A": [n for n in range(5, 156) if n != 60], "B": list(range(70))}
    cells = [("s", a, b, i, j, float(rng.uniform(0, 40))) for a, b in (("A", "B"), ("B", "A")) for i in numbers[a] for j in numbers[b]]
    cells.remove(gone := cells[777])
    rows = I.rows_of_pairs(spark.createDataFrame(cells, "structure_id string, chain_i string, chain_j string, i long, j long, pae double"))
    got = {(r.chain_i, r.chain_j): r for r in I.interface_counts(rows, 1.0).collect()}
    near = spark.createDataFrame([c[:5] for c in cells if c[3] % 3 == 0] + [gone[:5]], "structure_id string, chain_i string, chain_j string, i long, j long")
    close = {(r.chain_i, r.chain_j): r for r in I.interface_counts(rows, 1.0, near).collect()}
    for pair, row in got.items():
        hit = [c for c in cells if c[1:3] == pair and c[5] < 1.0]
        assert (row.pair_count, row.nres1, row.nres2) == (len(hit), len({c[3] for c in hit}), len({c[4] for c in hit}))
        hit = [c for c in hit if c[3] % 3 == 0]
        assert (close[pair].pair_count, close[pair].nres1, close[pair].nres2) == (len(hit), len({c[3] for c in hit}), len({c[4] for c in hit}))
    assert {r.n0chn for r in I.by_residue(rows, 15.0).collect()} == {220}
    want = {p: np.mean([(12 - c[5]) / 12 for c in cells if c[1:3] == p and c[5] <= 12]) for p in got}
    assert all(abs(r.lis - want[r.chain_i, r.chain_j]) < 1e-12 for r in I.lis(rows).collect())


def test_lowest_k_confidence(spark):
    ent = spark.createDataFrame([(1, 0, k, e) for k, e in enumerate([0.3, 0.1, 0.2, 0.7])], "candidate_id bigint, i bigint, j bigint, entropy double")
    assert D.lowest_k_confidence(ent, 3, "p").first().p == pytest.approx(1 - 0.2 / math.log(51))


def test_default_midpoints():
    mids = D.default_midpoints()
    assert len(mids) == 128 and mids[0] == 1.5 and mids[-1] == 54.5


def test_unused_pairs_have_no_logits_raised(spark):
    """A pair that no figure uses takes no softmax: the plan raises logits behind the condition only."""
    df = spark.range(1).selectExpr("id AS candidate_id", "0L AS i", "id AS j", "array(1D, 2D) AS logits")
    term = D.ContactTerm("v", F.col("i") == 0, F.col("j") == 7, 1, 5.0)
    for out in (D.contact_loss(df, [1.0, 9.0], term.rows, term.cols, 1, 5.0, "v"), D.structure_losses(df, [1.0, 9.0], [term])):
        text = out._jdf.queryExecution().optimizedPlan().toString()
        assert "END AS logits" in text and out.first().v == 0.0


def test_contact_loss_counts_rows_without_columns(spark):
    logits = spark.createDataFrame([(1, i, j, [float(i), float(j), 1.0]) for i in range(2) for j in range(2)], "candidate_id bigint, i bigint, j bigint, logits array<double>")
    out = D.contact_loss(logits, [1.0, 2.0, 9.0], F.lit(True), F.col("j") > F.col("i"), 1, 5.0, "v").first()
    w = np.exp([0.0, 1.0, 1.0])
    px, lp = w[:2] / w[:2].sum(), np.log(w / w.sum())[:2]
    assert out.v == pytest.approx(-(px * lp).sum() / (1 + 1e-8) / (2 + 1e-8))


def test_structure_losses_equal_the_single_ones(spark):
    """One pass gives what each loss gives alone; a term without rows is null, a row without columns counts 0."""
    rng = np.random.default_rng(3)
    cells = [(c, i, j, rng.normal(size=8).tolist()) for c in range(3) for i in range(6) for j in range(6)]
    df = spark.createDataFrame(cells, "candidate_id bigint, i bigint, j bigint, logits array<double>")
    mids, i, j = [float(3 * k + 1) for k in range(8)], F.col("i"), F.col("j")
    terms = [D.ContactTerm("a", i >= 4, j >= 4, 2, 9.0, 2), D.ContactTerm("b", i < 4, j >= 4, 1, 14.0), D.hotspot_term((1, 3), 4, 2, 9.0, (1,)), D.cdr_term((0,), 4, 3, 9.0),
             D.ContactTerm("none", i > 90, j > 0, 1, 9.0)]
    out = {r.candidate_id: r for r in D.structure_losses(df, mids, terms, ((i >= 4) & (j >= 4), 2), D.HingeTerm(i.isin(1, 3), j >= 4, 2, 7.0, 0.9)).collect()}
    for t in terms[:4]:
        single = D.contact_loss(df, mids, t.rows, t.cols, t.k, t.cutoff, t.name, t.min_sep)
        assert all(out[r.candidate_id][t.name] == pytest.approx(r[t.name], abs=1e-12) for r in single.collect())
    assert all(out[r.candidate_id].glob_loss == pytest.approx(r.glob_loss) for r in D.globularity(df, mids, (i >= 4) & (j >= 4), 2).collect())
    probs = D.contact_probability(df.filter(i.isin(1, 3) & (j >= 4)), mids, 7.0, inclusive=True)
    hinge = D.hotspot_hinge(D.topk_contact(probs, 2), 0.9)
    assert all(out[r.candidate_id].hotspot_hinge == pytest.approx(r.hotspot_hinge) for r in hinge.collect())
    assert all(r.none is None for r in out.values())


def test_matrix_takes_the_first_usable_key(spark):
    docs = [
        (1, '{"chain_pair_iptm": 0.5, "chain_pair_ipTM": [[0, 0.7], [0.6, null]]}'),
        (2, '{"chain_pair_iptm": {"x": 1}, "chain_pair_interface_iptm": {"0": {"1": 0.4}, "1": [0.3, 0.2]}}'),
        (3, '{"other": [[1]]}'),
    ]
    df = spark.createDataFrame(docs, "id int, doc string")
    got = sorted((r.id, r.source_key, r.i, r.j, r.value) for r in I.normalise_matrix(df, "id", "doc").filter("value is not null").collect())
    assert got == [
        (1, "chain_pair_ipTM", 0, 0, 0.0), (1, "chain_pair_ipTM", 0, 1, 0.7), (1, "chain_pair_ipTM", 1, 0, 0.6),
        (2, "chain_pair_interface_iptm", 0, 1, 0.4), (2, "chain_pair_interface_iptm", 1, 0, 0.3), (2, "chain_pair_interface_iptm", 1, 1, 0.2),
    ]


def test_weighted_binder_target_score(spark):
    matrix = spark.createDataFrame([(1, "D", "A", 0.8), (1, "A", "D", 0.6), (1, "D", "B", 0.2), (1, "B", "D", None)], "structure_id bigint, chain_a string, chain_b string, value double")
    roles = spark.createDataFrame([(1, "A", "target", 30), (1, "B", "target", 10), (1, "D", "binder", 5)], "structure_id bigint, chain string, role string, length int")
    whole = spark.createDataFrame([(1, 0.5), (2, 0.4)], "structure_id bigint, complex_iptm double")
    out = {r.structure_id: r for r in I.binder_target_iptm(matrix, roles, whole).collect()}
    assert out[1].binder_target_iptm == pytest.approx((0.7 * 30 + 0.2 * 10) / 40) and out[1].binder_target_iptm_unweighted == pytest.approx(0.45)
    assert (out[2].iptm, out[2].iptm_scope) == (0.4, "complex")


def test_chain_pair_values_are_finite(spark):
    from bindscope.operators.interface import chain_pair_values

    values = [float("inf"), float("-inf"), float("nan"), None, 0.5]
    matrix = spark.createDataFrame([(str(i), "A", "B", v) for i, v in enumerate(values)], "structure_id string, chain_a string, chain_b string, value double")
    roles = spark.createDataFrame([(str(i), c, r) for i in range(5) for c, r in (("A", "binder"), ("B", "target"))], "structure_id string, chain string, role string")
    assert [r.value for r in chain_pair_values(matrix, roles).collect()] == [0.5]


def test_docking_scores_with_numbers_per_chain(spark):
    """Residue 0 of chain A is not residue 0 of chain B."""
    rows = [("s", 0, 0, "A", "B", 3.0), ("s", 0, 0, "B", "A", 3.0)]
    contacts = spark.createDataFrame(rows, "structure_id string, i long, j long, chain_i string, chain_j string, distance double")
    pae = contacts.withColumnRenamed("distance", "pae")
    residues = spark.createDataFrame([("s", "A", 0, 90.0), ("s", "B", 0, 10.0)], "structure_id string, chain string, residue long, plddt double")
    got = I.contact_scores(contacts, residues, I.rows_of_pairs(pae)).collect()
    assert [(r.n_pairs, round(r.pdockq, 4)) for r in got] == [(1, 0.0183)] * 2
    top, slope, mid, base = I.PDOCKQ2
    want = top / (1 + math.exp(-slope * (50 / (1 + (3 / 10) ** 2) - mid))) + base
    assert all(abs(r.pdockq2 - want) < 1e-12 for r in got)


def test_distance_rmse_with_numbers_per_chain(spark):
    schema = "id string, chain string, residue long, x double, y double, z double"
    pred = spark.createDataFrame([("p", "A", 0, 0.0, 0.0, 0.0), ("p", "B", 0, 3.0, 0.0, 0.0), ("q", "A", 0, 1.0, 0.0, 0.0)], schema)
    ref = spark.createDataFrame([("p", "A", 0, 0.0, 0.0, 0.0), ("p", "B", 0, 5.0, 0.0, 0.0), ("q", "A", 0, 1.0, 0.0, 0.0)], schema)
    pairs = G.paired_distances(pred, ref, "id")
    assert {r.id: r.distance_rmse for r in G.distance_rmse(pairs, ["id"], "upper").collect()} == {"p": 2.0, "q": None}
    full = {r.id: r.distance_rmse for r in G.distance_rmse(pairs, ["id"]).collect()}
    assert full["q"] is None and abs(full["p"] - math.sqrt(2)) < 1e-12


def test_hotspot_variants(spark):
    """Residue 0 of chain A is near a framework atom, residue 1 near a CDR side chain; chain C is far."""
    rows = [("s", "A", 0, False, True, 0.0), ("s", "A", 1, False, True, 20.0), ("s", "C", 0, False, False, 100.0), ("s", "C", 5, False, True, None),
            ("s", "B", 0, False, True, 3.0), ("s", "B", 1, True, False, 22.0), ("s", "B", 1, True, True, 27.0)]
    df = spark.createDataFrame([(i, c, r, cdr, rep, x, 0.0 if x is not None else None, 0.0) for i, c, r, cdr, rep, x in rows],
                               "structure_id string, chain string, residue long, cdr boolean, rep boolean, x double, y double, z double")
    spots = spark.createDataFrame([("s", "A", 0), ("s", "A", 1), ("s", "C", 0), ("s", "C", 5), ("s", "A", 1)], "structure_id string, chain string, residue long")
    out = {(r.chain, r.variant): r for r in G.hotspot_variants(df, spots, F.col("chain") == "B", F.col("cdr"), F.col("rep"), 5.0).collect()}
    figures = lambda c, v: (out[c, v].contact_fraction, out[c, v].min_distance_mean, out[c, v].min_distance_min, out[c, v].hotspot_count)
    assert figures("A", "whole") == (1.0, 2.5, 2.0, 2) and figures("C", "whole") == (0.0, 73.0, 73.0, 1)
    assert figures(None, "whole") == (pytest.approx(2 / 3), 26.0, 2.0, 3) and not out["C", "whole"].hotspot_pass
    assert figures("A", "region") == (0.5, 12.0, 2.0, 2) and figures("A", "representative") == (0.5, 5.0, 3.0, 2)
    assert figures("A", "region_representative") == (0.0, 17.0, 7.0, 2) and ("C", "representative") not in out
