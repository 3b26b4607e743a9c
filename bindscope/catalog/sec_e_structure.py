"""Fronts, runs, spans, registers and selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.catalog.fragments import SCORED, scored_rows
from bindscope.operators import pareto as P
from bindscope.operators import structure as T


@query(
    "e10_pareto_fronts",
    f"""WITH RECURSIVE {SCORED}, d AS (SELECT DISTINCT model_name, critic_iptm AS x, ev AS y FROM sc WHERE ranking_eligible),
        n AS (SELECT *, row_number() OVER (ORDER BY model_name, x DESC, y DESC) AS id FROM d),
        walk AS (SELECT id, 1 AS depth FROM n UNION SELECT b.id, w.depth + 1 FROM walk w JOIN n a ON a.id = w.id JOIN n b
          ON b.model_name = a.model_name AND b.id > a.id AND b.y <= a.y),
        f AS (SELECT n.model_name, n.x, n.y, max(depth) AS front FROM walk JOIN n USING (id) GROUP BY 1, 2, 3)
        SELECT sc.validation_id, sc.model_name, cast(f.front AS bigint) AS pareto_front FROM sc LEFT JOIN f ON sc.ranking_eligible
          AND f.model_name = sc.model_name AND f.x = sc.critic_iptm AND f.y = sc.ev""",
)
def e10(c):
    rows = P.pareto_fronts(scored_rows(c), "critic_iptm", "evaluator_score", by=["model_name"], eligible="ranking_eligible")
    return rows.select("validation_id", "model_name", "pareto_front")


@query(
    "j4_pareto_per_group",
    """WITH RECURSIVE d AS (SELECT DISTINCT l_linenumber AS g, l_discount AS x, l_tax AS y FROM lineitem),
       n AS (SELECT *, row_number() OVER (ORDER BY g, x DESC, y DESC) AS id FROM d),
       walk AS (SELECT id, 1 AS depth FROM n UNION SELECT b.id, w.depth + 1 FROM walk w JOIN n a ON a.id = w.id JOIN n b ON b.g = a.g AND b.id > a.id AND b.y <= a.y)
       SELECT g, x, y, cast(max(depth) AS bigint) AS pareto_front FROM walk JOIN n USING (id) GROUP BY 1, 2, 3""",
)
def j4(c):
    pts = c.lineitem.select(F.col("l_linenumber").alias("g"), F.col("l_discount").alias("x"), F.col("l_tax").alias("y")).distinct()
    return P.pareto_fronts(pts, "x", "y", ["g"])


RUNS = """i AS (SELECT DISTINCT l_orderkey, l_linenumber AS idx FROM lineitem), g AS (SELECT *, idx - row_number() OVER (PARTITION BY l_orderkey ORDER BY idx) AS g FROM i),
    rn AS (SELECT l_orderkey, min(idx) AS s, max(idx) + 1 AS e FROM g GROUP BY l_orderkey, g)"""


@query("e12_index_runs", f"""WITH {RUNS} SELECT l_orderkey, string_agg(CASE WHEN e - s = 1 THEN s::varchar ELSE s || '-' || (e - 1) END, '+' ORDER BY s) AS runs, count(*) AS n FROM rn GROUP BY 1""")
def e12(c):
    runs = T.index_runs(c.lineitem, ["l_orderkey"], "l_linenumber")
    n = runs.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return T.runs_text(runs, ["l_orderkey"]).join(n, "l_orderkey")


@query("e13_mask_runs", """SELECT p_partkey, p_name, array_to_string(list_transform(regexp_extract_all(regexp_replace(p_name, '[aeiou]', '#', 'g'), '#+'), lambda x: len(x)), ',') AS lengths FROM part""")
def e13(c):
    mask = F.regexp_replace("p_name", "[aeiou]", "#")
    return c.part.select("p_partkey", "p_name", F.array_join(T.mask_runs(mask), ",").alias("lengths"))


@query("e14_chain_spans", """WITH c AS (SELECT l_orderkey, l_linenumber, cast(sum(l_quantity) AS bigint) AS length FROM lineitem GROUP BY 1, 2)
    SELECT l_orderkey, l_linenumber, cast(coalesce(sum(length) OVER w, 0) AS bigint) AS "start", cast(coalesce(sum(length) OVER w, 0) + length AS bigint) AS "end" FROM c
    WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def e14(c):
    chains = c.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("bigint").alias("length"))
    return T.chain_spans(chains, ["l_orderkey"], "l_linenumber").select("l_orderkey", "l_linenumber", "start", "end")


@query("e15_index_residues", """WITH a AS (SELECT l_orderkey, l_partkey % 50 AS res, l_returnflag AS atom, min(l_suppkey * 100 + l_linenumber) AS pos FROM lineitem GROUP BY 1, 2, 3),
    s AS (SELECT *, min(pos) OVER (PARTITION BY l_orderkey, res) AS st FROM a)
    SELECT l_orderkey, res, atom AS atom_name, pos AS position, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY st) - 1 AS residue_index FROM s""")
def e15(c):
    atoms = c.lineitem.select(
        "l_orderkey", (F.col("l_partkey") % 50).alias("res"), F.col("l_returnflag").alias("atom_name"), (F.col("l_suppkey") * 100 + F.col("l_linenumber")).alias("position")
    ).distinct()
    out = T.index_residues(atoms.withColumn("first_at", F.col("position")), ["l_orderkey"], ["res"], "position", carry=("first_at",))
    return out.select("l_orderkey", "res", "atom_name", F.col("first_at").alias("position"), "residue_index")


@query("e16_canonical_chain_ids", """WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS input_id FROM lineitem),
    n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, input_id ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn, coalesce(nullif(input_id, ''), 'chain') AS base FROM c)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN rn = 1 THEN base ELSE base || '_' || rn END AS canonical_chain_id FROM n""")
def e16(c):
    chains = c.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")).alias("input_id"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("chain_order"),
    )
    return T.canonical_chain_ids(chains, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "canonical_chain_id")


@query("e17_round_robin_framework", """WITH f AS (SELECT DISTINCT canonical FROM v_aliases), n AS (SELECT canonical, row_number() OVER (ORDER BY canonical) - 1 AS slot, count(*) OVER () AS total FROM f)
    SELECT o_orderkey AS design_index, canonical AS framework FROM orders JOIN n ON o_orderkey % total = slot""")
def e17(c):
    designs = c.orders.select(F.col("o_orderkey").alias("design_index"))
    return T.assign_round_robin(designs, c.v_aliases.select("canonical").distinct())


@query("e18_free_chain_id", """WITH u AS (SELECT l_orderkey, chr(65 + l_linenumber - 1) AS chain FROM lineitem), a AS (SELECT unnest(string_split('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789', '')) AS id, unnest(range(0, 62)) AS ord)
    SELECT o.l_orderkey, min_by(a.id, a.ord) AS free_chain FROM (SELECT DISTINCT l_orderkey FROM u) o CROSS JOIN a WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.l_orderkey = o.l_orderkey AND u.chain = a.id) GROUP BY 1""")
def e18(c):
    chains = c.lineitem.select("l_orderkey", F.char(F.col("l_linenumber").cast("bigint") + 64).alias("chain"))
    return T.free_chain_id(chains, "l_orderkey")


def _register(c):
    """Residues with two numberings: label = index + 1, author = label shifted in chain B."""
    number = F.col("residue") + 1
    return c.v_atoms.select(
        "structure_id", "chain", F.col("residue").alias("index"),
        F.when(F.col("chain") == "A", number).otherwise(number + 100).cast("string").alias("auth_seq_id"),
        F.when(F.col("residue") % 7 == 3, "A").otherwise("").alias("ins_code"), number.cast("string").alias("label_seq_id"),
    )


@query("b17_select_residues", """WITH s AS (SELECT vec_id AS structure_id, unnest(['A', 'A', 'B', 'B']) AS chain, unnest([1, 2, 3, 4]) AS selector_id,
      unnest([(vec_id % 9 + 1)::varchar, '2-6', '112-115', '999']) AS selector FROM embeddings),
    r AS (SELECT structure_id, chain, residue, residue + 1 AS lab, CASE WHEN chain = 'A' THEN residue + 1 ELSE residue + 101 END AS auth, CASE WHEN residue % 7 = 3 THEN 'A' ELSE '' END AS ins FROM v_atoms),
    h AS (SELECT s.structure_id, s.chain, selector_id, residue, 'a' AS k FROM s JOIN r USING (structure_id, chain) WHERE (selector LIKE '%-%' AND auth BETWEEN split_part(selector, '-', 1)::int AND split_part(selector, '-', 2)::int) OR (selector NOT LIKE '%-%' AND auth || ins = selector)
      UNION ALL SELECT s.structure_id, s.chain, selector_id, residue, 'l' FROM s JOIN r USING (structure_id, chain) WHERE (selector LIKE '%-%' AND lab BETWEEN split_part(selector, '-', 1)::int AND split_part(selector, '-', 2)::int) OR (selector NOT LIKE '%-%' AND lab::varchar = selector)),
    g AS (SELECT structure_id, chain, selector_id, coalesce(list_sort(list(residue) FILTER (k = 'a')), []) AS a, coalesce(list_sort(list(residue) FILTER (k = 'l')), []) AS l FROM h GROUP BY 1, 2, 3),
    v AS (SELECT s.structure_id, s.chain, s.selector_id, CASE WHEN a IS NULL THEN 'unmatched' WHEN len(a) > 0 AND len(l) > 0 AND a <> l THEN 'ambiguous' ELSE 'ok' END AS status, CASE WHEN len(a) > 0 THEN a ELSE l END AS x FROM s LEFT JOIN g USING (structure_id, chain, selector_id))
    SELECT structure_id, chain, selector_id, status, unnest(CASE WHEN status = 'ok' THEN x ELSE [NULL] END) AS index FROM v""")
def b17(c):
    sel = c.embeddings.select(
        F.col("vec_id").alias("structure_id"),
        F.inline(F.array(
            F.struct(F.lit("A").alias("chain"), F.lit(1).alias("selector_id"), (F.col("vec_id") % 9 + 1).cast("string").alias("selector")),
            F.struct(F.lit("A").alias("chain"), F.lit(2).alias("selector_id"), F.lit("2-6").alias("selector")),
            F.struct(F.lit("B").alias("chain"), F.lit(3).alias("selector_id"), F.lit("112-115").alias("selector")),
            F.struct(F.lit("B").alias("chain"), F.lit(4).alias("selector_id"), F.lit("999").alias("selector")),
        )),
    )
    return T.select_residues(_register(c), sel)


@query("b18_select_chains", """WITH c AS (SELECT l_orderkey AS structure_id, 'C' || l_linenumber AS chain_id, min(l_returnflag) AS auth, max(l_linestatus) AS label FROM lineitem GROUP BY 1, 2),
    n AS (SELECT DISTINCT structure_id, chain_id, unnest([chain_id, auth, label]) AS requested FROM c),
    q AS (SELECT structure_id, unnest(['C1', 'R', 'O', 'zz']) AS requested FROM (SELECT DISTINCT structure_id FROM c))
    SELECT q.structure_id, q.requested, CASE count(n.chain_id) WHEN 1 THEN 'ok' WHEN 0 THEN 'unknown' ELSE 'ambiguous' END AS status,
    CASE WHEN count(n.chain_id) = 1 THEN min(n.chain_id) END AS chain_id FROM q LEFT JOIN n USING (structure_id, requested) GROUP BY 1, 2""")
def b18(c):
    chains = c.lineitem.groupBy(
        F.col("l_orderkey").alias("structure_id"), F.concat(F.lit("C"), F.col("l_linenumber").cast("string")).alias("chain_id")
    ).agg(F.min("l_returnflag").alias("auth_asym_id"), F.max("l_linestatus").alias("label_asym_id"))
    wanted = F.explode(F.array(*[F.lit(x) for x in ("C1", "R", "O", "zz")])).alias("requested")
    req = c.lineitem.select(F.col("l_orderkey").alias("structure_id")).distinct().select("structure_id", wanted)
    return T.select_chains(chains, req)


ALPHABET = "ACDEFGHIKLMNPQRSTVWYX"


def _letters(c):
    letter = F.substring(F.lit(ALPHABET), (F.col("residue") + 1).cast("int"), F.lit(1))
    return c.v_atoms.withColumn("letter", letter)


# A residue counts as observed when it lies below this height.
OBSERVED = "z < 2"


@query("c11_overlay_observed", """WITH r AS (SELECT structure_id, 'A' AS la, residue + 1 AS ls, substr('ACDEFGHIKLMNPQRSTVWYX', (residue + 1)::int, 1) AS letter, x, z FROM v_atoms)
    SELECT structure_id, cast(ls AS varchar) AS label_seq_id, letter, CASE WHEN NOT z < 2 THEN 'unresolved' WHEN ls % 9 = 0 THEN 'mismatch' ELSE 'observed' END AS status,
    CASE WHEN z < 2 THEN x END AS x FROM r""")
def c11(c):
    base = _letters(c).withColumn("n", F.col("residue") + 1)
    register = base.select(
        "structure_id", F.lit("A").alias("label_asym_id"), F.col("n").cast("string").alias("label_seq_id"), F.lit("H").alias("auth_asym_id"),
        (F.col("n") + 500).cast("string").alias("auth_seq_id"), F.lit("").alias("ins_code"), "letter",
    )
    by_label = F.col("n") % 2 == 1
    observed = base.filter(OBSERVED).select(
        "structure_id", F.lit("A").alias("label_asym_id"), F.when(by_label, F.col("n").cast("string")).otherwise("").alias("label_seq_id"),
        F.lit("H").alias("auth_asym_id"), F.when(~by_label, (F.col("n") + 500).cast("string")).otherwise("").alias("auth_seq_id"),
        F.lit("").alias("ins_code"), F.when(F.col("n") % 9 == 0, "Z").otherwise(F.col("letter")).alias("letter"), F.col("n").alias("position"), "x", "y", "z",
    )
    return T.overlay_observed(register, observed).select("structure_id", "label_seq_id", "letter", "status", "x")


@query("j3_align_register", """SELECT structure_id, residue AS ordinal, cast(residue AS bigint) AS position, CASE WHEN structure_id % 2 = 0 THEN 'direct' ELSE 'aligned' END AS status
    FROM v_atoms WHERE z < 2""")
def j3(c):
    rows = _letters(c).filter(OBSERVED).select(
        "structure_id", F.col("residue").alias("ordinal"), "letter", F.lit(ALPHABET).alias("full_sequence"),
        F.when(F.col("structure_id") % 2 == 0, (F.col("residue") + 1).cast("string")).otherwise("?").alias("auth_seq_id"),
    )
    return T.align_register(rows, ["structure_id"])


@query("h11_mask_positions", """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ''), lambda ch, i: CASE WHEN i - 1 IN (p_partkey % 5, p_partkey % 5 + 1) THEN '#' ELSE ch END), '') AS masked FROM part""")
def h11(c):
    pos = F.array((F.col("p_partkey") % 5).cast("bigint"), (F.col("p_partkey") % 5 + 1).cast("bigint"))
    return c.part.select("p_partkey", T.mask_positions("p_name", pos).alias("masked"))
