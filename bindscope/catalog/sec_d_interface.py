"""Interface scores over predicted aligned error."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.catalog.sec_d_geometry import D_AB
from bindscope.operators import geometry as G
from bindscope.operators import interface as I

CUT, NEAR = 15.0, 8.0


def r6(*names):
    return [F.round(n, 6).alias(n) for n in names]


def d0_sql(n: str) -> str:
    return f"greatest(1.0, 1.24 * pow(greatest({n}, 27) - 15, 1.0 / 3.0) - 1.8)"


BYRES = f"""n AS (SELECT structure_id, chain_i, chain_j, i, count(*) AS lenj, count(*) FILTER (pae < 15) AS n0res FROM v_pae GROUP BY 1, 2, 3, 4),
    c AS (SELECT structure_id, chain_i, chain_j, count(*) + max(lenj) AS n0chn, count(*) FILTER (n0res > 0) AS ti FROM n GROUP BY 1, 2, 3),
    tj AS (SELECT structure_id, chain_i, chain_j, count(DISTINCT j) AS tj FROM v_pae WHERE pae < 15 GROUP BY 1, 2, 3),
    s AS (SELECT n.*, c.n0chn, c.ti, coalesce(tj.tj, 0) AS tj, c.ti + coalesce(tj.tj, 0) AS n0dom,
      {d0_sql('c.n0chn')} AS d0chn, {d0_sql('(c.ti + coalesce(tj.tj, 0))')} AS d0dom, {d0_sql('n.n0res')} AS d0res
      FROM n JOIN c USING (structure_id, chain_i, chain_j) LEFT JOIN tj USING (structure_id, chain_i, chain_j)),
    br AS (SELECT s.structure_id, s.chain_i, s.chain_j, s.i, any_value(n0res) AS n0res, any_value(n0chn) AS n0chn, any_value(n0dom) AS n0dom,
      any_value(ti) AS ti, any_value(tj) AS tj, any_value(d0res) AS d0res,
      avg(1 / (1 + pow(pae / d0chn, 2))) AS iptm_d0chn, coalesce(avg(1 / (1 + pow(pae / d0chn, 2))) FILTER (pae < 15), 0) AS ipsae_d0chn,
      coalesce(avg(1 / (1 + pow(pae / d0dom, 2))) FILTER (pae < 15), 0) AS ipsae_d0dom, coalesce(avg(1 / (1 + pow(pae / d0res, 2))) FILTER (pae < 15), 0) AS ipsae
      FROM s JOIN v_pae p ON p.structure_id = s.structure_id AND p.chain_i = s.chain_i AND p.chain_j = s.chain_j AND p.i = s.i GROUP BY 1, 2, 3, 4),
    asy AS (SELECT structure_id, chain_i, chain_j, max(ipsae) AS ipsae, max(ipsae_d0chn) AS ipsae_d0chn, max(ipsae_d0dom) AS ipsae_d0dom, max(iptm_d0chn) AS iptm_d0chn,
      max(n0chn) AS n0chn, max(n0dom) AS n0dom, max(ti) AS nres1, max(tj) AS nres2 FROM br GROUP BY 1, 2, 3)"""

NEARBY = f"""ct AS (SELECT a.structure_id, a.chain AS chain_i, b.chain AS chain_j, a.residue AS i, b.residue AS j FROM v_atoms a JOIN v_atoms b
      ON a.structure_id = b.structure_id AND a.chain <> b.chain WHERE {D_AB} <= 8),
    allp AS (SELECT DISTINCT structure_id, chain_i, chain_j FROM v_pae),
    tch AS (SELECT structure_id, chain_i, chain_j, i AS residue FROM ct UNION SELECT structure_id, chain_i, chain_j, j FROM ct),
    mp AS (SELECT structure_id, chain_i, chain_j, avg(plddt) AS mean_plddt FROM tch JOIN v_residues USING (structure_id, residue) GROUP BY 1, 2, 3),
    np AS (SELECT structure_id, chain_i, chain_j, count(*) AS n_pairs FROM ct GROUP BY 1, 2, 3),
    pq AS (SELECT structure_id, chain_i, chain_j, coalesce(n_pairs, 0) AS n_pairs,
      coalesce(0.724 / (1 + exp(-0.052 * (mean_plddt * log10(n_pairs) - 152.611))) + 0.018, 0) AS pdockq
      FROM allp LEFT JOIN np USING (structure_id, chain_i, chain_j) LEFT JOIN mp USING (structure_id, chain_i, chain_j)),
    mt AS (SELECT structure_id, chain_i, chain_j, avg(1 / (1 + pow(pae / 10, 2))) AS mean_ptm FROM ct JOIN v_pae USING (structure_id, chain_i, chain_j, i, j) GROUP BY 1, 2, 3),
    pq2 AS (SELECT structure_id, chain_i, chain_j, coalesce(1.31 / (1 + exp(-0.075 * (mean_plddt * mean_ptm - 84.733))) + 0.005, 0) AS pdockq2
      FROM allp LEFT JOIN mt USING (structure_id, chain_i, chain_j) LEFT JOIN mp USING (structure_id, chain_i, chain_j)),
    ls AS (SELECT structure_id, chain_i, chain_j, coalesce(avg((12 - pae) / 12) FILTER (pae <= 12), 0) AS lis FROM v_pae GROUP BY 1, 2, 3)"""


def contacts(c):
    return G.contact_pairs(c.v_atoms, NEAR)


def asym(c):
    return I.asym_scores(I.by_residue(c.v_pae_rows, CUT))


@query("d27_iptm_d0chn", f"WITH {BYRES} SELECT structure_id, chain_i, chain_j, round(iptm_d0chn, 6) AS iptm_d0chn FROM asy")
def d27(c):
    return I.iptm_d0chn(c.v_pae_rows).select(*I.PAIR, *r6("iptm_d0chn"))


@query("d28_ipsae_by_residue", f"""WITH {BYRES} SELECT structure_id, chain_i, chain_j, i, cast(n0res AS int) AS n0res, n0chn, n0dom, round(d0res, 6) AS d0res,
    round(iptm_d0chn, 6) AS iptm_d0chn, round(ipsae_d0chn, 6) AS ipsae_d0chn, round(ipsae_d0dom, 6) AS ipsae_d0dom, round(ipsae, 6) AS ipsae FROM br""")
def d28r(c):
    rows = I.by_residue(c.v_pae_rows, CUT)
    return rows.select(*I.PAIR, "i", "n0res", "n0chn", "n0dom", *r6("d0res", "iptm_d0chn", "ipsae_d0chn", "ipsae_d0dom", "ipsae"))


@query("d28_ipsae_asymmetric", f"""WITH {BYRES} SELECT structure_id, chain_i, chain_j, round(ipsae, 6) AS ipsae, round(ipsae_d0chn, 6) AS ipsae_d0chn,
    round(ipsae_d0dom, 6) AS ipsae_d0dom, n0chn, n0dom, nres1, nres2 FROM asy""")
def d28a(c):
    return asym(c).select(*I.PAIR, *r6("ipsae", "ipsae_d0chn", "ipsae_d0dom"), "n0chn", "n0dom", "nres1", "nres2")


@query("d29_pdockq", f"WITH {NEARBY} SELECT structure_id, chain_i, chain_j, n_pairs, round(pdockq, 6) AS pdockq FROM pq")
def d29(c):
    return I.pdockq(contacts(c), c.v_residues).select(*I.PAIR, "n_pairs", *r6("pdockq"))


@query("d30_pdockq2", f"WITH {NEARBY} SELECT structure_id, chain_i, chain_j, round(pdockq2, 6) AS pdockq2 FROM pq2")
def d30(c):
    return I.pdockq2(contacts(c), c.v_pae_rows, c.v_residues).select(*I.PAIR, *r6("pdockq2"))


@query("d31_lis", f"""WITH {NEARBY} SELECT structure_id, least(chain_i, chain_j) AS chain_a, greatest(chain_i, chain_j) AS chain_b, round(avg(lis), 6) AS lis FROM ls GROUP BY 1, 2, 3""")
def d31(c):
    return I.symmetric_mean(I.lis(c.v_pae_rows), "lis").select("structure_id", "chain_a", "chain_b", *r6("lis"))


@query("d32_interface_counts", f"""WITH {NEARBY}, p AS (SELECT * FROM v_pae WHERE pae < 15),
    a AS (SELECT structure_id, chain_i, chain_j, count(*) AS pair_count, count(DISTINCT i) AS nres1, count(DISTINCT j) AS nres2 FROM p GROUP BY 1, 2, 3),
    b AS (SELECT structure_id, chain_i, chain_j, count(DISTINCT i) AS dist1, count(DISTINCT j) AS dist2 FROM p SEMI JOIN ct USING (structure_id, chain_i, chain_j, i, j) GROUP BY 1, 2, 3)
    SELECT structure_id, chain_i, chain_j, pair_count, nres1, nres2, coalesce(dist1, 0) AS dist1, coalesce(dist2, 0) AS dist2 FROM a LEFT JOIN b USING (structure_id, chain_i, chain_j)""")
def d32(c):
    near = I.interface_counts(c.v_pae_rows, CUT, contacts(c)).select(*I.PAIR, F.col("nres1").alias("dist1"), F.col("nres2").alias("dist2"))
    return I.interface_counts(c.v_pae_rows, CUT).join(near, list(I.PAIR), "left").na.fill({"dist1": 0, "dist2": 0})


@query("d33_pair_summary", f"""WITH {BYRES}, {NEARBY} SELECT structure_id, least(chain_i, chain_j) AS chain_a, greatest(chain_i, chain_j) AS chain_b, round(max(ipsae), 6) AS ipsae,
    round(max(ipsae_d0chn), 6) AS ipsae_d0chn, round(max(ipsae_d0dom), 6) AS ipsae_d0dom, round(max(iptm_d0chn), 6) AS iptm_d0chn, round(max(pdockq2), 6) AS pdockq2,
    round(avg(lis), 6) AS lis, round(max(pdockq), 6) AS pdockq FROM asy JOIN pq USING (structure_id, chain_i, chain_j) JOIN pq2 USING (structure_id, chain_i, chain_j)
    JOIN ls USING (structure_id, chain_i, chain_j) GROUP BY 1, 2, 3""")
def d33(c):
    return I.pair_summary(I.full_scores(c.v_pae_rows, CUT, contacts(c), c.v_residues)).select(
        "structure_id", "chain_a", "chain_b", *r6("ipsae", "ipsae_d0chn", "ipsae_d0dom", "iptm_d0chn", "pdockq2", "lis", "pdockq")
    )


def roles(c):
    """Chain D binds; A, B, C are targets of different length. One row per chain seen."""
    seen = c.v_chain_scores.select("structure_id", F.col("chain_a").alias("chain")).distinct()
    return seen.select(
        "structure_id", "chain", F.when(F.col("chain") == "D", "binder").otherwise("target").alias("role"),
        (F.ascii("chain") * 3 - 188).alias("length"),
    )


_CPV = """cpv AS (SELECT structure_id, 'D' AS binder_chain, CASE WHEN chain_a = 'D' THEN chain_b ELSE chain_a END AS target_chain, value,
    CASE WHEN chain_a = 'D' THEN 'forward' ELSE 'reverse' END AS direction FROM v_chain_scores WHERE value IS NOT NULL AND (chain_a = 'D' OR chain_b = 'D'))"""


@query("c17_chain_pair_values", f"WITH {_CPV} SELECT * FROM cpv")
def c17(c):
    return I.chain_pair_values(c.v_chain_scores, roles(c)).select("structure_id", "binder_chain", "target_chain", "value", "direction")


@query("d15_scoped_pair_metric", f"""WITH {_CPV}, p AS (SELECT structure_id, target_chain, min(value) AS v FROM cpv GROUP BY 1, 2)
    SELECT structure_id, min(v) AS value, max(v) AS max_value, round(avg(v), 6) AS mean_value, count(*) AS pairs FROM p GROUP BY 1""")
def d15(c):
    return I.scoped_pair_metric(c.v_chain_scores, roles(c)).select("structure_id", "value", "max_value", *r6("mean_value"), "pairs")


def _matrix_json(c):
    """All 64 numbers of a vector as an 8 x 8 matrix: a list of lists, or objects with numeric names."""
    cell = lambda i, j: F.floor(F.abs(F.get("embedding", (i * 8 + j).cast("int")).cast("double")) * 1000).cast("bigint").cast("string")
    eight = F.sequence(F.lit(0), F.lit(7))
    name = lambda k: F.concat(F.lit('"'), k.cast("string"), F.lit('":'))
    rows = F.transform(eight, lambda i: F.concat(F.lit("["), F.array_join(F.transform(eight, lambda j: cell(i, j)), ","), F.lit("]")))
    objects = F.transform(eight, lambda i: F.concat(name(i), F.lit("{"), F.array_join(F.transform(eight, lambda j: F.concat(name(j), cell(i, j))), ","), F.lit("}")))
    listed = F.concat(F.lit('{"chain_pair_ipTM":['), F.array_join(rows, ","), F.lit("]}"))
    keyed = F.concat(F.lit('{"chain_pair_interface_iptm":null,"chain_pair_iptm":{'), F.array_join(objects, ","), F.lit("}}"))
    return c.embeddings.select("vec_id", F.when(F.col("vec_id") % 2 == 0, listed).otherwise(keyed).alias("payload"))


@query("d16_normalise_matrix", """SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN 'chain_pair_ipTM' ELSE 'chain_pair_iptm' END AS source_key, (k // 8)::int AS i, (k % 8)::int AS j,
    floor(abs(cast(embedding[k + 1] AS double)) * 1000) AS value FROM embeddings, range(0, 64) r(k)""")
def d16(c):
    return I.normalise_matrix(_matrix_json(c), "vec_id", "payload")


@query("d17_binder_target_iptm", f"""WITH {_CPV}, p AS (SELECT structure_id, target_chain, avg(value) AS v, ascii(target_chain) * 3 - 188 AS len FROM cpv GROUP BY 1, 2),
    g AS (SELECT structure_id, sum(v * len) / sum(len) AS w, avg(v) AS u, string_agg(target_chain, ',' ORDER BY target_chain) AS chains FROM p GROUP BY 1)
    SELECT e.vec_id AS structure_id, round(g.w, 6) AS binder_target_iptm, round(g.u, 6) AS binder_target_iptm_unweighted, chains,
    CASE WHEN g.w IS NULL THEN 'complex' ELSE 'binder_target' END AS iptm_scope FROM embeddings e LEFT JOIN g ON g.structure_id = e.vec_id""")
def d17(c):
    whole = c.embeddings.select(F.col("vec_id").alias("structure_id"), F.lit(0.5).alias("complex_iptm"))
    out = I.binder_target_iptm(c.v_chain_scores, roles(c), whole)
    return out.select("structure_id", *r6("binder_target_iptm", "binder_target_iptm_unweighted"), F.array_join(F.map_keys("by_chain"), ",").alias("chains"), "iptm_scope")


@query("d18_plddt_means", """SELECT structure_id, round(avg(plddt), 6) AS plddt_complex, round(avg(plddt) FILTER (chain = 'A'), 6) AS plddt_target,
    round(avg(plddt) FILTER (chain = 'B'), 6) AS plddt_binder FROM v_residues GROUP BY 1""")
def d18(c):
    rows = c.v_residues.select(
        "structure_id", F.when(F.col("structure_id") % 2 == 0, F.col("plddt") / 100).otherwise(F.col("plddt")).alias("plddt"),
        F.when(F.col("chain") == "A", "target").otherwise("binder").alias("role"),
    )
    return I.plddt_means(rows).select("structure_id", *r6("plddt_complex", "plddt_target", "plddt_binder"))


@query("d34_scope_ipsae", f"""WITH {BYRES} SELECT structure_id, round(max(ipsae), 6) AS value, 'A-B' AS best_pair, cast(1 AS bigint) AS pairs,
    round(min(ipsae), 6) AS ipsae_min, round(max(ipsae), 6) AS ipsae_max FROM asy GROUP BY 1""")
def d34(c):
    role = F.when(F.col("chain") == "B", "binder").otherwise("target").alias("role")
    members = c.v_residues.select("structure_id", "chain").distinct().select("structure_id", "chain", role)
    out = I.scope_ipsae(asym(c), members)
    return out.select("structure_id", *r6("value"), "best_pair", "pairs", *r6("ipsae_min", "ipsae_max"))


@query("d35_chain_types", """WITH r AS (SELECT structure_id, chain, CASE WHEN structure_id % 5 = 0 AND residue > 15 THEN 'DA' ELSE 'ALA' END AS res_name FROM v_residues),
    t AS (SELECT structure_id, chain, CASE WHEN bool_or(res_name IN ('DA', 'DC', 'DT', 'DG', 'A', 'C', 'U', 'G')) THEN 'nucleic_acid' ELSE 'protein' END AS chain_type FROM r GROUP BY 1, 2)
    SELECT a.structure_id, a.chain AS chain_i, b.chain AS chain_j, CASE WHEN 'nucleic_acid' IN (a.chain_type, b.chain_type) THEN 'nucleic_acid' ELSE 'protein' END AS pair_type
    FROM t a JOIN t b ON a.structure_id = b.structure_id AND a.chain <> b.chain""")
def d35(c):
    name = F.when((F.col("structure_id") % 5 == 0) & (F.col("residue") > 15), "DA").otherwise("ALA")
    return I.pair_types(I.chain_types(c.v_residues.select("structure_id", "chain", name.alias("res_name"))))
