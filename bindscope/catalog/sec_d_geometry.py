"""Geometry, contacts and pose agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.operators import geometry as G

_D = "sqrt(pow({a}.x - {b}.x, 2) + pow({a}.y - {b}.y, 2) + pow({a}.z - {b}.z, 2))"
D_AB = _D.format(a="a", b="b")


def binder():
    return F.col("chain") == "B"


def hotspots(c):
    """Three hotspot residues of chain A per structure; the last one is never resolved."""
    return c.embeddings.select(
        F.col("vec_id").alias("structure_id"), F.lit("A").alias("chain"),
        F.explode(F.array((F.col("vec_id") % 5), F.col("vec_id") % 5 + 4, F.lit(30).cast("bigint"))).alias("residue"),
    )


HOT = """hot AS (SELECT vec_id AS structure_id, 'A' AS chain, unnest([vec_id % 5, vec_id % 5 + 4, 30]) AS residue FROM embeddings),
    hd AS (SELECT h.structure_id, h.chain, h.residue, min(""" + D_AB + """) AS distance FROM hot h
      LEFT JOIN v_atoms a ON a.structure_id = h.structure_id AND a.chain = h.chain AND a.residue = h.residue
      LEFT JOIN v_atoms b ON b.structure_id = a.structure_id AND b.chain = 'B' GROUP BY 1, 2, 3)"""

PAIRS = """pr AS (SELECT r.structure_id // 2 AS pair_id, r.chain, r.residue, r.x AS rx, r.y AS ry, r.z AS rz, p.x AS px, p.y AS py, p.z AS pz
      FROM v_atoms r JOIN v_atoms p ON p.structure_id = r.structure_id + 1 AND p.residue = r.residue WHERE r.structure_id % 2 = 0),
    pd AS (SELECT a.pair_id, a.chain AS chain_i, b.chain AS chain_j, a.residue AS i, b.residue AS j,
      sqrt(pow(a.px - b.px, 2) + pow(a.py - b.py, 2) + pow(a.pz - b.pz, 2)) AS dp,
      sqrt(pow(a.rx - b.rx, 2) + pow(a.ry - b.ry, 2) + pow(a.rz - b.rz, 2)) AS dr FROM pr a JOIN pr b USING (pair_id))"""


_PARTS = [(i, j) for i in range(4) for j in range(i, 4)]


def fit_sql(source: str, keys: str) -> str:
    """CTE ``fit`` (keys, n, g, lam, rot, centroids): superposition of p onto r by the quaternion
    matrix of the nine sums, its leading eigenvector by squaring; g - lam is the residual."""
    at = lambda m, i, j: f"{m}[{_PARTS.index((min(i, j), max(i, j))) + 1}]"
    diagonal = ["vxx + vyy + vzz", "vxx - vyy - vzz", "vyy - vxx - vzz", "vzz - vxx - vyy"]
    upper = {(0, 1): "vyz - vzy", (0, 2): "vzx - vxz", (0, 3): "vxy - vyx", (1, 2): "vxy + vyx", (1, 3): "vzx + vxz", (2, 3): "vyz + vzy"}
    entries = ", ".join(diagonal[i] if i == j else upper[i, j] for i, j in _PARTS)
    norm2 = lambda m: " + ".join(f"{1 if i == j else 2} * {at(m, i, j)} * {at(m, i, j)}" for i, j in _PARTS)
    start = ", ".join(f"{at('k', i, j)} / f + {1 if i == j else 0}" for i, j in _PARTS)
    square = ", ".join("(" + " + ".join(f"{at('a', i, k)} * {at('a', k, j)}" for k in range(4)) + f") / ({norm2('a')})" for i, j in _PARTS)
    column = " ".join(
        f"WHEN {at('p', j, j)} >= greatest({', '.join(at('p', i, i) for i in range(4))}) THEN [{', '.join(at('p', i, j) for i in range(4))}]" for j in range(4)
    )
    value = " + ".join(f"{1 if i == j else 2} * q[{i + 1}] * q[{j + 1}] * {at('k', i, j)}" for i, j in _PARTS)
    w, x, y, z = (f"q[{i}]" for i in range(1, 5))
    rot = (f"{w}*{w}+{x}*{x}-{y}*{y}-{z}*{z}, 2*({x}*{y}+{w}*{z}), 2*({x}*{z}-{w}*{y}), 2*({x}*{y}-{w}*{z}), {w}*{w}-{x}*{x}+{y}*{y}-{z}*{z}, 2*({y}*{z}+{w}*{x}), "
           f"2*({x}*{z}+{w}*{y}), 2*({y}*{z}-{w}*{x}), {w}*{w}-{x}*{x}-{y}*{y}+{z}*{z}")
    sums = ", ".join(f"covar_pop(p{a}, r{b}) AS v{a}{b}" for a in "xyz" for b in "xyz")
    spread = " + ".join(f"var_pop({s}{c})" for s in "pr" for c in "xyz")
    means = ", ".join(f"avg({s}{c}) AS {s}c{c}" for s in "pr" for c in "xyz")
    return f"""fs AS (SELECT {keys}, count(*) AS n, {means}, {spread} AS g, {sums} FROM {source} GROUP BY {keys}),
    fk AS (SELECT *, [{entries}] AS k FROM fs), fm AS (SELECT *, sqrt({norm2('k')}) AS f FROM fk), f0 AS (SELECT *, [{start}] AS m FROM fm),
    fp AS (SELECT *, list_reduce(list_transform(range(0, 61), lambda i: m), lambda a, b: [{square}]) AS p FROM f0),
    fc AS (SELECT *, CASE {column} END AS c FROM fp), fq AS (SELECT *, list_transform(c, lambda v: v / sqrt(c[1]*c[1]+c[2]*c[2]+c[3]*c[3]+c[4]*c[4])) AS q FROM fc),
    fit AS (SELECT *, 2 * ({value}) AS lam, [{rot}] AS rot FROM fq)"""


def _turned(c: int) -> str:
    return " + ".join(f"(a.p{x} - f.pc{x}) * f.rot[{3 * r + c + 1}]" for r, x in enumerate("xyz")) + f" + f.rc{'xyz'[c]}"


RMSD = "sqrt(greatest(g - lam, 0))"


def sides(c):
    """Even structures are references, the next odd one its prediction."""
    pair = F.floor(F.col("structure_id") / 2).cast("bigint").alias("pair_id")
    cols = [pair, "chain", "residue", "x", "y", "z"]
    ref = c.v_atoms.filter("structure_id % 2 = 0").select(*cols)
    return c.v_atoms.filter("structure_id % 2 = 1").select(*cols), ref


def sequences(c, odd: bool):
    """Chain rows with text: residues lettered by position and parity."""
    letter = F.substring(F.lit("DEFGHIKLMNPQRSTVWY"), (F.col("residue") % 7 + 1).cast("int"), F.lit(1))
    rows = c.v_atoms.filter(f"structure_id % 2 = {int(odd)}").groupBy(
        F.floor(F.col("structure_id") / 2).cast("bigint").alias("pair_id"), "chain"
    ).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("residue", letter.alias("l")))), lambda s: s["l"]), "").alias("sequence"))
    return rows.withColumn("chain_order", F.ascii("chain"))


@query(
    "c13_pick_binder_chain",
    """WITH s AS (SELECT structure_id, chain, count(*) AS n FROM v_atoms GROUP BY 1, 2),
       w AS (SELECT *, CASE WHEN structure_id % 3 = 0 THEN 'B' WHEN structure_id % 3 = 1 THEN 'Z' ELSE '' END AS wid,
             CASE WHEN structure_id % 2 = 0 THEN 10 ELSE 99 END AS wlen FROM s),
       k AS (SELECT *, row_number() OVER (PARTITION BY structure_id ORDER BY CASE WHEN wid <> '' AND chain = wid THEN 0 WHEN n = wlen THEN 1 ELSE 3 END, chain) AS rn FROM w)
       SELECT structure_id, chain FROM k WHERE rn = 1""",
)
def c13(c):
    chains = c.v_atoms.groupBy("structure_id", "chain").agg(F.count(F.lit(1)).cast("int").alias("n")).select(
        "structure_id", "chain", F.ascii("chain").alias("chain_order"), F.repeat(F.lit("A"), F.col("n")).alias("sequence"),
        F.when(F.col("structure_id") % 3 == 0, "B").when(F.col("structure_id") % 3 == 1, "Z").otherwise("").alias("wid"),
        F.when(F.col("structure_id") % 2 == 0, "A" * 10).otherwise("A" * 99).alias("wseq"),
    )
    return G.pick_binder(chains, ["structure_id"], "wid", "wseq").select("structure_id", "chain")


@query(
    "c12_match_chains",
    """SELECT structure_id // 2 AS pair_id, chain AS src_chain, chain AS dst_chain FROM v_atoms WHERE structure_id % 2 = 0 GROUP BY 1, 2""",
)
def c12(c):
    return G.match_chains(sequences(c, False), sequences(c, True), "pair_id")


@query(
    "c14_zip_atoms",
    """WITH a AS (SELECT structure_id // 2 AS pair_id, row_number() OVER (PARTITION BY structure_id ORDER BY residue) AS ordinal, x FROM v_atoms WHERE structure_id % 2 = 0 AND chain = 'A'),
       b AS (SELECT structure_id // 2 AS pair_id, row_number() OVER (PARTITION BY structure_id ORDER BY residue) AS ordinal, x FROM v_atoms WHERE structure_id % 2 = 1 AND chain = 'B')
       SELECT pair_id, ordinal, a.x AS ax, b.x AS bx FROM a JOIN b USING (pair_id, ordinal)""",
)
def c14(c):
    pred, ref = sides(c)
    out = G.zip_atoms(ref.filter("chain = 'A'"), pred.filter("chain = 'B'"), ["pair_id"], "residue")
    return out.select("pair_id", F.col("ordinal").cast("bigint").alias("ordinal"), "ax", "bx")


@query("c15_hotspot_distances", f"WITH {HOT} SELECT structure_id, chain, residue, round(distance, 6) AS distance FROM hd")
def c15(c):
    return G.hotspot_distances(c.v_atoms, hotspots(c), binder()).withColumn("distance", F.round("distance", 6))


@query("c16_distogram", f"""SELECT a.structure_id, a.residue AS i, b.residue AS j, a.chain, round({D_AB}, 6) AS distance, true AS mask
    FROM v_atoms a JOIN v_atoms b ON a.structure_id = b.structure_id AND a.chain = b.chain""")
def c16(c):
    out = G.distogram(c.v_atoms)
    return out.select("structure_id", "i", "j", F.col("chain_i").alias("chain"), F.round("distance", 6).alias("distance"), "mask")


@query("d19_score_hotspots", f"""WITH {HOT}, g AS (SELECT structure_id, min(distance) AS d, count(*) AS n FROM hd GROUP BY 1)
    SELECT structure_id, round(d, 6) AS hotspot_distance, n AS hotspot_count, coalesce(d <= 8, false) AS hotspot_pass, 'A:31' AS missing_residues,
    CASE WHEN d > 8 THEN 'validation hotspot distance ' || printf('%.4f', d) || ' exceeds cutoff 8.0000' END AS hotspot_fail_reason FROM g""")
def d19(c):
    return G.score_hotspots(c.v_atoms, hotspots(c), binder(), 8.0).select(
        "structure_id", F.round("hotspot_distance", 6).alias("hotspot_distance"), "hotspot_count", "hotspot_pass", "missing_residues", "hotspot_fail_reason"
    )


@query("d20_hotspot_contact_metrics", f"""WITH {HOT} SELECT structure_id, round(avg(CASE WHEN distance <= 8 THEN 1.0 ELSE 0.0 END), 6) AS contact_fraction,
    round(avg(distance), 6) AS min_distance_mean, round(min(distance), 6) AS min_distance_min, count(*) AS hotspot_count FROM hd WHERE distance IS NOT NULL GROUP BY 1""")
def d20(c):
    out = G.hotspot_contact_metrics(c.v_atoms, hotspots(c), binder(), 8.0)
    return out.select("structure_id", *[F.round(n, 6).alias(n) for n in ("contact_fraction", "min_distance_mean", "min_distance_min")], "hotspot_count")


def two_atoms(c):
    """Half the residues, with a CA and a CB each where both exist, as in the next query."""
    half = F.floor(F.col("residue") / 2).cast("bigint")
    atoms = c.v_atoms.select(
        "structure_id", "chain", half.alias("residue"), F.when(F.col("residue") % 2 == 0, "CA").otherwise("CB").alias("atom_name"),
        F.when((F.col("structure_id") + half) % 4 == 0, "GLY").otherwise("LEU").alias("res_name"), "x", "y", "z",
    )
    chosen = G.representatives(atoms, ["structure_id", "chain", "residue"]).select("structure_id", "chain", "residue", "atom_name", F.lit(True).alias("rep"))
    return atoms.join(chosen, ["structure_id", "chain", "residue", "atom_name"], "left")


@query("d20_hotspot_variants", f"""WITH a AS (SELECT structure_id, chain, residue // 2 AS residue, CASE WHEN residue % 2 = 0 THEN 'CA' ELSE 'CB' END AS atom_name,
      CASE WHEN (structure_id + residue // 2) % 4 = 0 THEN 'GLY' ELSE 'LEU' END AS res_name, x, y, z FROM v_atoms),
    k AS (SELECT *, row_number() OVER (PARTITION BY structure_id, chain, residue ORDER BY CASE WHEN atom_name = 'CB' AND res_name <> 'GLY' THEN 0 WHEN atom_name = 'CA' THEN 1 ELSE 9 END) = 1
      AND (atom_name = 'CA' OR res_name <> 'GLY') AS rep FROM a),
    h AS (SELECT DISTINCT vec_id AS structure_id, 'A' AS chain, unnest([vec_id % 5, vec_id % 5 + 4, 30]) AS residue FROM embeddings),
    p AS (SELECT a.structure_id, a.chain, a.residue, {D_AB} AS d, a.rep AND b.rep AS rep, b.residue % 3 = 0 AS cdr
      FROM h JOIN k a USING (structure_id, chain, residue) JOIN k b ON b.structure_id = a.structure_id AND b.chain = 'B'),
    n AS (SELECT structure_id, chain, residue, unnest(['whole', 'region', 'representative', 'region_representative']) AS variant,
      unnest([min(d), min(d) FILTER (cdr), min(d) FILTER (rep), min(d) FILTER (rep AND cdr)]) AS d FROM p GROUP BY 1, 2, 3)
    SELECT structure_id, chain, variant, round(avg(CASE WHEN d <= 8 THEN 1.0 ELSE 0.0 END), 6) AS contact_fraction, round(avg(d), 6) AS min_distance_mean,
    round(min(d), 6) AS min_distance_min, count(*) AS hotspot_count, min(d) <= 8 AS hotspot_pass FROM n WHERE d IS NOT NULL
    GROUP BY GROUPING SETS ((structure_id, variant), (structure_id, chain, variant))""")
def d20v(c):
    out = G.hotspot_variants(two_atoms(c), hotspots(c), binder(), F.col("residue") % 3 == 0, F.col("rep"), 8.0)
    return out.select(
        "structure_id", "chain", "variant", *[F.round(n, 6).alias(n) for n in ("contact_fraction", "min_distance_mean", "min_distance_min")], "hotspot_count", "hotspot_pass"
    )


@query("d21_representative_atoms", """WITH a AS (SELECT structure_id, residue // 2 AS residue, CASE WHEN residue % 2 = 0 THEN 'CA' ELSE 'CB' END AS atom_name,
      CASE WHEN (structure_id + residue // 2) % 4 = 0 THEN 'GLY' ELSE 'LEU' END AS res_name, x FROM v_atoms),
    k AS (SELECT *, row_number() OVER (PARTITION BY structure_id, residue ORDER BY CASE WHEN atom_name = 'CB' AND res_name <> 'GLY' THEN 0 WHEN atom_name = 'CA' THEN 1 ELSE 9 END) AS rn FROM a)
    SELECT structure_id, residue, atom_name, x FROM k WHERE rn = 1""")
def d21(c):
    half = F.floor(F.col("residue") / 2).cast("bigint")
    atoms = c.v_atoms.select(
        "structure_id", half.alias("residue"), F.when(F.col("residue") % 2 == 0, "CA").otherwise("CB").alias("atom_name"),
        F.when((F.col("structure_id") + half) % 4 == 0, "GLY").otherwise("LEU").alias("res_name"), "x", "y", "z",
    )
    return G.representatives(atoms, ["structure_id", "residue"]).select("structure_id", "residue", "atom_name", "x")


@query("d22_distance_rmse", f"""WITH {PAIRS} SELECT pair_id, round(sqrt(avg(pow(dp - dr, 2))), 6) AS full_rmse,
    round(sqrt(avg(pow(dp - dr, 2)) FILTER (i < j)), 6) AS upper_rmse FROM pd GROUP BY 1""")
def d22(c):
    pairs = G.paired_distances(*sides(c), "pair_id")
    return pairs.groupBy("pair_id").agg(
        F.round(G.rmse_of_pairs("full"), 6).alias("full_rmse"), F.round(G.rmse_of_pairs("upper"), 6).alias("upper_rmse")
    )


@query("d23_aligned_rmsd", f"WITH {PAIRS}, {fit_sql('pr', 'pair_id')} SELECT pair_id, round({RMSD}, 6) AS aligned_rmsd, n AS residue_count FROM fit")
def d23(c):
    fit = G.aligned_rmsd(G.aligned_pairs(*sides(c), ["pair_id", "chain", "residue"]), ["pair_id"])
    return fit.select("pair_id", F.round("aligned_rmsd", 6).alias("aligned_rmsd"), "residue_count")


@query("d24_contact_recovery", f"""WITH {PAIRS} SELECT pair_id, round(count(*) FILTER (dr <= 8 AND dp <= 8) / nullif(count(*) FILTER (dr <= 8), 0), 6) AS contact_recovery_8,
    round(count(*) FILTER (dr <= 12 AND dp <= 12) / nullif(count(*) FILTER (dr <= 12), 0), 6) AS contact_recovery_12 FROM pd WHERE chain_i < chain_j GROUP BY 1""")
def d24(c):
    pairs = G.paired_distances(*sides(c), "pair_id").filter("chain_i < chain_j")
    out = G.contact_recovery(pairs, ["pair_id"])
    return out.select("pair_id", F.round("contact_recovery_8", 6).alias("contact_recovery_8"), F.round("contact_recovery_12", 6).alias("contact_recovery_12"))


@query("d25_geometry_diagnostics", f"""WITH {PAIRS}, {fit_sql('pr', 'pair_id, chain')},
    c AS (SELECT pair_id, chain_i AS chain, sqrt(avg(pow(dp - dr, 2))) AS distance_rmse FROM pd WHERE chain_i = chain_j GROUP BY 1, 2),
    a AS (SELECT pair_id, sqrt(avg(pow(dp - dr, 2))) AS pair_distance_rmse, count(*) AS residue_pair_count FROM pd WHERE chain_i < chain_j GROUP BY 1)
    SELECT pair_id, chain, round(distance_rmse, 6) AS distance_rmse, round({RMSD}, 6) AS aligned_rmsd, n AS residue_count,
    round(pair_distance_rmse, 6) AS pair_distance_rmse, residue_pair_count FROM fit JOIN c USING (pair_id, chain) JOIN a USING (pair_id)""")
def d25(c):
    chain, assembly = G.geometry_diagnostics(*sides(c), "pair_id")
    wide = assembly.groupBy("pair_id").agg(F.max("pair_distance_rmse").alias("pair_distance_rmse"), F.max("residue_pair_count").alias("residue_pair_count"))
    return chain.join(wide, "pair_id").select(
        "pair_id", "chain", F.round("distance_rmse", 6).alias("distance_rmse"), F.round("aligned_rmsd", 6).alias("aligned_rmsd"),
        "residue_count", F.round("pair_distance_rmse", 6).alias("pair_distance_rmse"), "residue_pair_count",
    )


@query("d26_pose_agreement", f"""WITH {PAIRS}, ta AS (SELECT * FROM pr WHERE chain = 'A'), {fit_sql('ta', 'pair_id')},
    b AS (SELECT a.pair_id, {', '.join(f'{_turned(k)} AS t{c}, a.r{c}' for k, c in enumerate('xyz'))} FROM pr a JOIN fit f USING (pair_id) WHERE a.chain = 'B'),
    g AS (SELECT pair_id, sqrt(avg(pow(tx - rx, 2) + pow(ty - ry, 2) + pow(tz - rz, 2))) AS d,
      sqrt(pow(avg(tx) - avg(rx), 2) + pow(avg(ty) - avg(ry), 2) + pow(avg(tz) - avg(rz), 2)) AS s FROM b GROUP BY 1)
    SELECT i.pair_id, round({RMSD}, 6) AS target_aligned_rmsd, round(d, 6) AS binder_ca_rmsd, round(d, 6) AS binder_backbone_rmsd, round(s, 6) AS binder_centroid_distance,
    CASE WHEN fit.n IS NULL THEN 'could not match target chains' END AS pose_error
    FROM (SELECT vec_id // 2 AS pair_id FROM embeddings WHERE vec_id % 2 = 0) i LEFT JOIN fit USING (pair_id) LEFT JOIN g USING (pair_id)""")
def d26(c):
    pred, ref = sides(c)
    match = G.match_chains(sequences(c, False).filter("chain = 'A'"), sequences(c, True).filter("chain = 'A'"), "pair_id")
    src = ref.join(match.select("pair_id", F.col("src_chain").alias("chain"), "dst_chain"), ["pair_id", "chain"])
    dst = pred.join(match.select("pair_id", F.col("dst_chain").alias("chain"), "dst_chain"), ["pair_id", "chain"])
    keys = ["pair_id", "dst_chain"]
    rename = lambda df: df.select("pair_id", *[F.col(f"a{x}").alias(f"f{x}") for x in "xyz"], *[F.col(f"b{x}").alias(f"m{x}") for x in "xyz"])
    target = rename(G.zip_atoms(src, dst, keys, "residue"))
    binders = rename(G.zip_atoms(ref.filter("chain = 'B'"), pred.filter("chain = 'B'"), ["pair_id"], "residue")).withColumn("is_ca", F.lit(True))
    ids = ref.select("pair_id").distinct()
    out = G.pose_agreement(target, binders, ids, "pair_id")
    return out.select("pair_id", *[F.round(n, 6).alias(n) for n in ("target_aligned_rmsd", "binder_ca_rmsd", "binder_backbone_rmsd", "binder_centroid_distance")], "pose_error")


@query("j1_kabsch_rotation", f"WITH {PAIRS}, {fit_sql('pr', 'pair_id')} SELECT pair_id, n, round(rot[1], 6) AS r00, round(rot[5], 6) AS r11, round(rot[9], 6) AS r22 FROM fit")
def j1(c):
    fit = G.superposition(G.aligned_pairs(*sides(c), ["pair_id", "chain", "residue"]), ["pair_id"], 3)
    return fit.select("pair_id", "n", F.round(F.get("rot", F.lit(0)), 6).alias("r00"), F.round(F.get("rot", F.lit(4)), 6).alias("r11"), F.round(F.get("rot", F.lit(8)), 6).alias("r22"))
