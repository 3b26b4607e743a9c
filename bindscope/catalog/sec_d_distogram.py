"""Contact probabilities, confidence and losses from distance logits."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.catalog.sec_d_interface import r6
from bindscope.operators import distogram as D
from bindscope.operators import geometry as G

MIDS = [3.0 + 1.5 * k for k in range(16)]
T, B = 11, 10
CDR = (1, 2, 3, 6, 7)
HOT = (0, 4, 7)

SM = """sm AS (SELECT candidate_id, i, j, logits, list_max(logits) AS m FROM v_logits),
    w AS (SELECT candidate_id, i, j, list_transform(logits, lambda v: exp(v - m)) AS w, list_transform(logits, lambda v: v - m) AS u FROM sm),
    z AS (SELECT *, list_sum(w) AS z FROM w)"""


def prob(n: int) -> str:
    return f"list_sum(w[1:{n}]) / z"


_MID_LIST = "[" + ", ".join(f"{m}::double" for m in MIDS) + "]"
XENT = "-list_sum(list_transform(list_zip(w[1:{n}], u[1:{n}]), lambda t: t[1] * (t[2] - ln(z)))) / list_sum(w[1:{n}])"


@query("d40_contact_probability", f"WITH {SM} SELECT candidate_id, i, j, round({prob(4)}, 6) AS p FROM z")
def d40(c):
    return D.contact_probability(c.v_logits, MIDS, 9.0).select("candidate_id", "i", "j", *r6("p"))


TOPK = f"""p AS (SELECT candidate_id, i, {prob(5)} AS p FROM z WHERE i IN (0, 4, 7) AND j >= 11),
    tk AS (SELECT candidate_id, i, list_avg(list_sort(list(p), 'DESC')[1:3]) AS score FROM p GROUP BY 1, 2)"""


def hotspot_scores(c):
    rows = c.v_logits.filter(F.col("i").isin(*HOT) & (F.col("j") >= T))
    return D.topk_contact(D.contact_probability(rows, MIDS, 9.0, inclusive=True), 3)


@query("d41_topk_contact", f"WITH {SM}, {TOPK} SELECT candidate_id, i, round(score, 6) AS score FROM tk")
def d41(c):
    return hotspot_scores(c).select("candidate_id", "i", *r6("score"))


@query("d42_cdr_contact_summary", f"""WITH {SM}, p AS (SELECT candidate_id, i, {prob(4)} AS p FROM z WHERE i >= 11 AND j < 11),
    tk AS (SELECT candidate_id, i, i IN (12, 13, 14, 17, 18) AS cdr, list_avg(list_sort(list(p), 'DESC')[1:2]) AS score FROM p GROUP BY 1, 2)
    SELECT candidate_id, round(min(score) FILTER (cdr), 6) AS probability_min, round(avg(score) FILTER (cdr), 6) AS probability_mean,
    round(max(score) FILTER (cdr), 6) AS probability_max, round(avg(pow(greatest(0, score - 0.2), 2)) FILTER (NOT cdr), 6) AS framework_penalty,
    round(max(score) FILTER (NOT cdr), 6) AS framework_probability_max, 'target_all' AS scope FROM tk GROUP BY 1""")
def d42(c):
    rows = c.v_logits.filter((F.col("i") >= T) & (F.col("j") < T))
    scores = D.topk_contact(D.contact_probability(rows, MIDS, 9.0), 2)
    cdr = F.col("i").isin([T + k for k in CDR])
    out = D.cdr_contact_summary(scores.filter(cdr), scores.filter(~cdr), 0.2, hotspots=False)
    return out.select("candidate_id", *r6("probability_min", "probability_mean", "probability_max", "framework_penalty", "framework_probability_max"), "scope")


@query("d43_hotspot_hinge", f"WITH {SM}, {TOPK} SELECT candidate_id, round(avg(pow(greatest(0, 0.6 - score) / 0.6, 2)), 6) AS hotspot_hinge FROM tk GROUP BY 1")
def d43(c):
    return D.hotspot_hinge(hotspot_scores(c), 0.6).select("candidate_id", *r6("hotspot_hinge"))


@query("d44_distogram_proxy", f"""WITH {SM}, q AS (SELECT candidate_id, i, list_transform(w[1:13], lambda v: v / z / (list_sum(w[1:13]) / z + 1e-8)) AS p FROM z WHERE i >= 11 AND j < 11),
    h AS (SELECT candidate_id, i, -list_sum(list_transform(p, lambda v: v * ln(v + 1e-10))) AS h FROM q),
    a AS (SELECT candidate_id, avg(h) AS h FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY h) AS rn FROM h) WHERE rn <= 10 GROUP BY 1),
    b AS (SELECT candidate_id, avg(h) AS h FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY h) AS rn FROM h WHERE i IN (12, 13, 14, 17, 18)) WHERE rn <= 5 GROUP BY 1)
    SELECT candidate_id, round(greatest(0, least(1, 1 - a.h / ln(51))), 6) AS distogram_iptm_proxy, round(greatest(0, least(1, 1 - b.h / ln(51))), 6) AS cdr_distogram_iptm_proxy
    FROM a JOIN b USING (candidate_id)""")
def d44(c):
    return D.distogram_proxy(c.v_logits, MIDS, T, B, CDR).select("candidate_id", *r6("distogram_iptm_proxy", "cdr_distogram_iptm_proxy"))


def losses(c):
    binder_i, binder_j = F.col("i") >= T, F.col("j") >= T
    intra = D.contact_loss(c.v_logits, MIDS, binder_i, binder_j, 2, 14.0, "intra_contact_loss", min_sep=9)
    inter = D.contact_loss(c.v_logits, MIDS, ~binder_i, binder_j, 1, 22.0, "inter_contact_loss")
    return intra.join(inter, "candidate_id")


LOSS = f"""l8 AS (SELECT candidate_id, i, j, {XENT.format(n=8)} AS h FROM z WHERE i >= 11),
    intra AS (SELECT candidate_id, sum(v) / (count(*) + 1e-8) AS intra_contact_loss FROM (SELECT candidate_id, i, coalesce(list_sum(l), 0) / (coalesce(len(l), 0) + 1e-8) AS v FROM
      (SELECT candidate_id, i, list_sort(list(h) FILTER (j >= 11 AND abs(i - j) >= 9))[1:2] AS l FROM l8 GROUP BY 1, 2)) GROUP BY 1),
    l13 AS (SELECT candidate_id, i, j, {XENT.format(n=13)} AS h FROM z WHERE i < 11 AND j >= 11),
    inter AS (SELECT candidate_id, sum(v) / (count(*) + 1e-8) AS inter_contact_loss FROM (SELECT candidate_id, i, min(h) / (1 + 1e-8) AS v FROM l13 GROUP BY 1, 2) GROUP BY 1),
    gl AS (SELECT candidate_id, sqrt(sum(e) / 100.0) - 2.38 * pow(10, 0.365) AS x FROM (SELECT candidate_id,
      list_sum(list_transform(list_zip(w, {_MID_LIST}), lambda t: t[1] * pow(least(t[2], 27), 2))) / z AS e FROM z WHERE i >= 11 AND j >= 11 AND i > j) GROUP BY 1),
    globl AS (SELECT candidate_id, CASE WHEN x > 0 THEN x ELSE exp(x) - 1 END AS glob_loss FROM gl)"""


@query("d45_contact_loss", f"WITH {SM}, {LOSS} SELECT candidate_id, round(intra_contact_loss, 6) AS intra_contact_loss, round(inter_contact_loss, 6) AS inter_contact_loss FROM intra JOIN inter USING (candidate_id)")
def d45(c):
    return losses(c).select("candidate_id", *r6("intra_contact_loss", "inter_contact_loss"))


def glob(c):
    return D.globularity(c.v_logits, MIDS, (F.col("i") >= T) & (F.col("j") >= T), B)


@query("d46_globularity", f"WITH {SM}, {LOSS} SELECT candidate_id, round(glob_loss, 6) AS glob_loss FROM globl")
def d46(c):
    return glob(c).select("candidate_id", *r6("glob_loss"))


DRIFT = f"""rf AS (SELECT a.structure_id AS candidate_id, a.residue AS i, b.residue AS j, least(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)), {MIDS[-1]}) AS ref
      FROM v_atoms a JOIN v_atoms b ON a.structure_id = b.structure_id AND a.chain = 'A' AND b.chain = 'A'),
    dr AS (SELECT candidate_id, sqrt(avg(pow(list_sum(list_transform(list_zip(w, {_MID_LIST}), lambda t: t[1] * t[2])) / z - ref, 2)) + 1e-8) AS drift_rmse
      FROM z JOIN rf USING (candidate_id, i, j) GROUP BY 1)"""


def drift(c):
    ref = G.distogram(c.v_atoms, chains=("A", "A")).select(F.col("structure_id").alias("candidate_id"), "i", "j", "distance", "mask")
    own = c.v_logits.filter((F.col("i") < T) & (F.col("j") < T))  # the pairs that have a reference
    return D.geometry_drift(own, ref, MIDS, 1.0, 2.0)


@query("d47_geometry_drift", f"WITH {SM}, {DRIFT} SELECT candidate_id, round(drift_rmse, 6) AS drift_rmse, round(greatest(0, (drift_rmse - 1) / 2), 6) AS drift_loss FROM dr")
def d47(c):
    return drift(c).select("candidate_id", *r6("drift_rmse", "drift_loss"))


EXTRA = f"""l10 AS (SELECT candidate_id, i, j, {XENT.format(n=10)} AS h FROM z),
    hl AS (SELECT candidate_id, sum(v) / (count(*) + 1e-8) AS hotspot_contact_loss FROM (SELECT candidate_id, i, list_sum(l) / (len(l) + 1e-8) AS v FROM
      (SELECT candidate_id, i, list_sort(list(h) FILTER (j >= 11))[1:3] AS l FROM l10 WHERE i IN (0, 4, 7) GROUP BY 1, 2)) GROUP BY 1),
    cl AS (SELECT candidate_id, sum(v) / (count(*) + 1e-8) AS cdr_contact_loss FROM (SELECT candidate_id, i, list_sum(l) / (len(l) + 1e-8) AS v FROM
      (SELECT candidate_id, i, list_sort(list(h) FILTER (j IN (0, 4, 7)))[1:2] AS l FROM l10 WHERE i IN (12, 13, 14, 17, 18) GROUP BY 1, 2)) GROUP BY 1)"""


def all_losses(c):
    binder_i, binder_j = F.col("i") >= T, F.col("j") >= T
    terms = [
        D.ContactTerm("intra_contact_loss", binder_i, binder_j, 2, 14.0, 9), D.ContactTerm("inter_contact_loss", ~binder_i, binder_j, 1, 22.0),
        D.hotspot_term(HOT, T, 3, 16.9), D.cdr_term(CDR, T, 2, 16.9, HOT),
    ]
    return D.structure_losses(c.v_logits, MIDS, terms, (binder_i & binder_j, B), D.HingeTerm(F.col("i").isin(*HOT), binder_j, 3, 9.0, 0.6))


@query("d45_hotspot_and_cdr_loss", f"WITH {SM}, {EXTRA} SELECT candidate_id, round(hotspot_contact_loss, 6) AS hotspot_contact_loss, round(cdr_contact_loss, 6) AS cdr_contact_loss FROM hl JOIN cl USING (candidate_id)")
def d45h(c):
    return all_losses(c).select("candidate_id", *r6("hotspot_contact_loss", "cdr_contact_loss"))


@query("d48_total_structure_score", f"""WITH {SM}, {LOSS}, {EXTRA}, {DRIFT}, {TOPK}, hh AS (SELECT candidate_id, avg(pow(greatest(0, 0.6 - score) / 0.6, 2)) AS h FROM tk GROUP BY 1)
    SELECT candidate_id, round(0.5 * intra_contact_loss + 0.5 * inter_contact_loss + 0.2 * glob_loss + 0.1 * greatest(0, (drift_rmse - 1) / 2) + 0.3 * h + 0.4 * cdr_contact_loss + 0.2 * hotspot_contact_loss, 6) AS total_loss
    FROM hl JOIN cl USING (candidate_id) JOIN intra USING (candidate_id) JOIN inter USING (candidate_id) JOIN globl USING (candidate_id) JOIN dr USING (candidate_id) JOIN hh USING (candidate_id)""")
def d48(c):
    parts = all_losses(c).join(drift(c), "candidate_id", "left")
    return D.total_structure_score(parts, D.ExtraWeights(drift=0.1, hotspot=0.3, cdr=0.4, hotspot_entropy=0.2)).select("candidate_id", *r6("total_loss"))
