"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.functions import scalars as S
from bindscope.operators import msa as A


@query("h1_slug", """SELECT page_id, coalesce(nullif(trim(lower(regexp_replace(trim(url), '[^A-Za-z0-9]+', '_', 'g')), '_'), ''), 'page') AS slug,
    coalesce(nullif(trim(lower(regexp_replace(substr(url, 5, 3), '[^A-Za-z0-9]+', '_', 'g')), '_'), ''), 'empty') AS fallback FROM pages""")
def h1(c):
    return c.pages.select("page_id", S.slug("url", "page").alias("slug"), S.slug(F.substring("url", 5, 3), "empty").alias("fallback"))


@query("h2_padded_ids", """WITH w AS (SELECT greatest(3, max(length(l_orderkey::varchar))) AS a, greatest(3, max(length(l_suppkey::varchar))) AS b FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_suppkey, 'cand_' || CASE WHEN length(l_orderkey::varchar) >= 4 THEN l_orderkey::varchar ELSE lpad(l_orderkey::varchar, 4, '0') END || '_' || lpad(l_linenumber::varchar, 4, '0') AS candidate_id,
    's' || lpad(l_orderkey::varchar, a::int, '0') || '_seed' || lpad(l_suppkey::varchar, b::int, '0') || '_c' || lpad(l_linenumber::varchar, 3, '0') AS stem FROM lineitem, w""")
def h2(c):
    width = lambda n: F.greatest(F.lit(3), F.max(F.length(F.col(n).cast("string"))))
    w = c.lineitem.agg(width("l_orderkey").alias("a"), width("l_suppkey").alias("b"))
    widths = [w.select("a").scalar(), w.select("b").scalar(), 3]
    return c.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", S.padded_id("cand", ["l_orderkey", "l_linenumber"], [4, 4]).alias("candidate_id"),
        S.artifact_stem(F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_linenumber"), widths).alias("stem"),
    )


@query("h3_binder_code", """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'mp' WHEN 1 THEN 'mp' WHEN 2 THEN 'scfv' WHEN 3 THEN 'vhh' WHEN 4 THEN 'binder' ELSE replace(p_name, ' ', '_') END AS code FROM part""")
def h3(c):
    k = F.col("p_partkey") % 6
    raw = F.when(k == 0, "Mini-Binder").when(k == 1, " MINIPROTEIN ").when(k == 2, "sc.fv").when(k == 3, "VHH").when(k == 4, "--").otherwise(F.col("p_name"))
    return c.part.select("p_partkey", S.binder_code(raw).alias("code"))


@query("h4_semantic_id", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, replace(p_name, ' ', '_') || '_mp_seed' || l_suppkey || CASE WHEN l_linenumber > 1 THEN '_c' || (l_linenumber - 1) ELSE '' END AS id
    FROM lineitem JOIN part ON p_partkey = l_partkey""")
def h4(c):
    j = c.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").join(c.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    j = j.withColumn("k", F.col("l_linenumber") - 1)
    return j.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", S.semantic_id("p_name", F.lit("minibinder"), "l_suppkey", "k").alias("id"))


@query("h5_task_id", """SELECT c_custkey, 'val_' || lower(replace(replace(c_name, '#', '_'), '-', '_')) || '_' || substr(sha256(c_name || '|' || c_mktsegment || '|cfg'), 1, 10) AS validation_id FROM customer""")
def h5(c):
    return c.customer.select("c_custkey", S.task_id("c_name", "c_mktsegment", F.lit("cfg")).alias("validation_id"))


@query("h6_job_id", "SELECT msa_job_id, 'msa_' || scope || '_' || substr(sha256(scope || '|' || cache_key || '|' || msa_context_hash), 1, 16) AS job_id FROM v_jobs")
def h6(c):
    return c.v_jobs.select("msa_job_id", S.job_id("scope", "cache_key", "msa_context_hash").alias("job_id"))


@query("h7_canonical_hash", """SELECT o_orderkey, sha256('{"custkey":' || o_custkey || ',"priority":"' || o_orderpriority || '","status":"' || o_orderstatus || '"}') AS compact,
    substr(sha256('{"custkey": ' || o_custkey || ', "priority": "' || o_orderpriority || '", "status": null}'), 1, 16) AS spaced FROM orders""")
def h7(c):
    fields = {"status": F.col("o_orderstatus"), "custkey": F.col("o_custkey"), "priority": F.col("o_orderpriority")}
    spaced = {**fields, "status": F.lit(None).cast("string")}
    return c.orders.select("o_orderkey", S.canonical_hash(fields).alias("compact"), S.canonical_hash(spaced, True, 16).alias("spaced"))


@query("h8_normalize_sequence", r"""SELECT doc_id, upper(regexp_replace(replace(text, 'ß', 'ss'), '[ \t\n\r\f\x0B]+', '', 'g')) AS sequence, regexp_matches(upper(regexp_replace(replace(text, 'ß', 'ss'), '[ \t\n\r\f\x0B]+', '', 'g')), '^[ACDEFGHIKLMNPQRSTVWYX]+$') AS is_protein FROM documents""")
def h8(c):
    return c.documents.select("doc_id", S.normalize_sequence("text").alias("sequence"), S.is_protein(S.normalize_sequence("text")).alias("is_protein"))


@query("h8_candidate_sequence", r"""SELECT candidate_id, upper(regexp_replace(designed_sequence, '[ \t\n\r\f\x0B]+', '', 'g')) AS sequence, regexp_matches(upper(regexp_replace(designed_sequence, '[ \t\n\r\f\x0B]+', '', 'g')), '^[ACDEFGHIKLMNPQRSTVWYX]+$') AS is_protein FROM v_candidates""")
def h8_candidates(c):
    rows = c.v_candidates
    return rows.select("candidate_id", S.normalize_sequence("designed_sequence").alias("sequence"), S.is_protein(S.normalize_sequence("designed_sequence")).alias("is_protein"))


@query("h9_template_key", """SELECT o_orderkey, sha256(substr(s, 1, 8) || '|' || substr(s, 9, 6) || '|' || substr(s, 15, 10) || '|' || substr(s, 25)) AS framework_hash,
    '{"cdr1_register":"r' || o_custkey % 5 || '","cdr2_register":"r1","cdr3_register":"r2","chain_class":"vhh","fr1_length":8,"fr2_length":6,"fr3_length":10,"fr4_length":8,"numbering_scheme":"imgt"}' AS key_lengths,
    '{"cdr1_register":"r' || o_custkey % 5 || '","cdr2_register":"r1","cdr3_register":"r2","chain_class":"vhh","fr1":"' || substr(s, 1, 8) || '","fr2":"' || substr(s, 9, 6) || '","fr3":"' || substr(s, 15, 10) || '","fr4":"' || substr(s, 25) || '","numbering_scheme":"imgt"}' AS key_exact
    FROM (SELECT *, translate(md5(o_orderkey::varchar), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') AS s FROM orders)""")
def h9(c):
    s = F.translate(F.md5(F.col("o_orderkey").cast("string")), "0123456789abcdef", "ACDEFGHIKLMNPQRS")
    base = c.orders.select("o_orderkey", s.alias("s"), F.concat(F.lit("r"), (F.col("o_custkey") % 5).cast("string")).alias("cdr1_register"))
    seg = base.select(
        "o_orderkey", "cdr1_register", F.lit("r1").alias("cdr2_register"), F.lit("r2").alias("cdr3_register"), F.lit("imgt").alias("numbering_scheme"), F.lit("vhh").alias("chain_class"),
        F.substring("s", 1, 8).alias("fr1"), F.substring("s", 9, 6).alias("fr2"), F.substring("s", 15, 10).alias("fr3"), F.substring("s", 25, 99).alias("fr4"),
    )
    return seg.select("o_orderkey", A.framework_hash(*A.REGIONS).alias("framework_hash"), A.template_key().alias("key_lengths"), A.template_key("exact").alias("key_exact"))


@query("h10_extract_by_template", """SELECT o_orderkey, regexp_extract(s, 'A([A-Z]{2,5})D([A-Z]{1,9})F', 1) AS cdr1, regexp_extract(s, 'A([A-Z]{2,5})D([A-Z]{1,9})F', 2) AS cdr2, 3 AS retained_length,
    cast(instr(s, regexp_extract(s, 'A([A-Z]{2,5})D([A-Z]{1,9})F', 0)) AS int) AS match_start FROM (SELECT o_orderkey, translate(md5(o_orderkey::varchar), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') AS s FROM orders) WHERE regexp_matches(s, 'A([A-Z]{2,5})D([A-Z]{1,9})F')""")
def h10(c):
    seqs = c.orders.select("o_orderkey", F.translate(F.md5(F.col("o_orderkey").cast("string")), "0123456789abcdef", "ACDEFGHIKLMNPQRS").alias("sequence"))
    return A.extract_by_template(seqs, "A{cdr1}D{cdr2}F", {"cdr1": (2, 5), "cdr2": (1, 9)}).select("o_orderkey", "cdr1", "cdr2", "retained_length", "match_start")


_PANEL = """s AS (SELECT o_orderkey, translate(md5(o_orderkey::varchar), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') AS s FROM orders),
    t AS (SELECT 't' || s_suppkey AS template_id, substr(m, 1, 3) AS a, substr(m, 4, 1) AS b, substr(m, 5, 2) AS c FROM
      (SELECT s_suppkey, translate(md5(s_suppkey::varchar), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') AS m FROM supplier)),
    p AS (SELECT *, a || '([A-Z]{2,9})' || b || '([A-Z]{1,12})' || c AS pattern FROM t),
    x AS (SELECT o_orderkey, template_id, regexp_extract(s, pattern, 1) AS cdr1, regexp_extract(s, pattern, 2) AS cdr2,
      cast(instr(s, regexp_extract(s, pattern, 0)) AS int) AS match_start FROM s JOIN p ON contains(s.s, p.a) WHERE regexp_matches(s, pattern)),
    r AS (SELECT *, list_transform(range(0, 6), lambda k: match_start + k + CASE WHEN k > 2 THEN length(cdr1) ELSE 0 END + CASE WHEN k > 3 THEN length(cdr2) ELSE 0 END) AS kept FROM x),
    m AS (SELECT *, len(list_filter(kept, lambda k: (o_orderkey + k) % 11 = 0)) AS missing FROM r)"""


def panel_matches(c):
    """Templates of three literals and two holes, one per supplier, against all chains; residue
    numbers whose sum with the order's number divides by 11 have no atoms."""
    letters = lambda k: F.translate(F.md5(F.col(k).cast("string")), "0123456789abcdef", "ACDEFGHIKLMNPQRS")
    seqs = c.orders.select("o_orderkey", letters("o_orderkey").alias("sequence"))
    part = lambda a, n: F.substring("m", a, n)
    made = c.supplier.select("s_suppkey", letters("s_suppkey").alias("m"))
    panel = made.select(
        F.concat(F.lit("t"), F.col("s_suppkey").cast("string")).alias("template_id"),
        F.concat(part(1, 3), F.lit("([A-Z]{2,9})"), part(4, 1), F.lit("([A-Z]{1,12})"), part(5, 2)).alias("pattern"),
        F.array(F.lit("cdr1"), F.lit("cdr2")).alias("regions"), F.array(part(1, 3), part(4, 1), part(5, 2)).alias("literals"),
    )
    observed = seqs.select("o_orderkey", F.explode(F.sequence(F.lit(1), F.length("sequence"))).alias("number")).filter("(o_orderkey + number) % 11 <> 0")
    return A.count_missing(A.extract_by_panel(A.with_observed(seqs, observed, ["o_orderkey"]), panel))


@query("h10_template_panel", f"WITH {_PANEL} SELECT o_orderkey, template_id, cdr1, cdr2, match_start, 6 AS retained_length, array_to_string(kept, ',') AS kept, missing FROM m")
def h10p(c):
    return panel_matches(c).select(
        "o_orderkey", "template_id", F.col("holes.cdr1").alias("cdr1"), F.col("holes.cdr2").alias("cdr2"), "match_start", "retained_length",
        F.array_join(F.col("retained").cast("array<string>"), ",").alias("kept"), "missing",
    )


@query("h10_best_source", f"WITH {_PANEL} SELECT template_id, o_orderkey, missing FROM m QUALIFY row_number() OVER (PARTITION BY template_id ORDER BY missing, o_orderkey) = 1")
def h10b(c):
    return A.best_source(panel_matches(c), ["template_id"], "missing", "o_orderkey").select("template_id", "o_orderkey", "missing")


@query("h12_render_number", """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, regexp_replace(printf('%.3f', l_extendedprice / 7), '\\.?0+$', '') AS price, regexp_replace(printf('%.3f', l_tax), '\\.?0+$', '') AS repaired, l_returnflag AS kept FROM lineitem""")
def h12(c):
    quoted = F.concat(F.lit("'"), F.col("l_tax").cast("string"))
    return c.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", S.render_number(F.col("l_extendedprice") / 7).alias("price"),
        S.repair_quoted_number(quoted).alias("repaired"), S.repair_quoted_number("l_returnflag").alias("kept"),
    )


@query("h13_hotspot_flag", """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN true ELSE l_discount > 0 END AS flag FROM lineitem""")
def h13(c):
    n = F.col("l_linenumber")
    raw = F.when(n == 1, F.lit(None).cast("string")).when(n == 2, "").when(n == 3, "yes").otherwise(F.col("l_discount").cast("string"))
    return c.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", S.hotspot_flag(raw).alias("flag"))


@query("h14_d0_and_kernel", """SELECT p_partkey, round(greatest(1.0, 1.24 * pow(greatest(p_size * 10, 27) - 15, 1.0 / 3.0) - 1.8), 6) AS d0_protein, round(greatest(2.0, 1.24 * pow(greatest(p_size * 10, 27) - 15, 1.0 / 3.0) - 1.8), 6) AS d0_nucleic,
    round(1 / (1 + pow(p_retailprice / 100 / 4.0, 2)), 6) AS kernel FROM part""")
def h14(c):
    n = F.col("p_size") * 10
    return c.part.select(
        "p_partkey", F.round(S.d0(n), 6).alias("d0_protein"), F.round(S.d0(n, True), 6).alias("d0_nucleic"),
        F.round(S.ptm_kernel(F.col("p_retailprice") / 100, F.lit(4.0)), 6).alias("kernel"),
    )


@query("h15_bin_midpoints", """SELECT p_partkey, round(CASE p_partkey % 128 WHEN 0 THEN 1.5 WHEN 127 THEN 54.5 ELSE 2 + 50.0::double / 126 * (p_partkey % 128 - 0.5) END, 6) AS midpoint FROM part""")
def h15(c):
    return c.part.select("p_partkey", F.round(F.get(S.bin_midpoints(), (F.col("p_partkey") % 128).cast("int")), 6).alias("midpoint"))


@query("h16_distance_bin", """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, cast(greatest(0, least(63, ceil((l_quantity / 2 - 2) / 0.3125) - 1)) AS int) AS bin FROM lineitem""")
def h16(c):
    return c.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", S.distance_bin(F.col("l_quantity") / 2).alias("bin"))


@query("h17_residue_letter", """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, CASE l_partkey % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'W' WHEN 2 THEN 'X' ELSE 'L' END AS letter FROM lineitem""")
def h17(c):
    k = F.col("l_partkey") % 4
    name = F.when(k == 0, " gly").when(k == 1, "TRP").when(k == 2, "HOH").otherwise("Leu")
    return c.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", S.residue_letter(name).alias("letter"))


@query("h18_chain_letter", """SELECT c_custkey, cast(c_nationkey AS int) AS back, chr(65 + c_nationkey) AS letter, cast(-1 AS int) AS bad FROM customer""")
def h18(c):
    letter = S.chain_letter("c_nationkey")
    return c.customer.select("c_custkey", S.chain_index(letter).alias("back"), letter.alias("letter"), S.chain_index(F.concat(letter, F.lit("1"))).alias("bad"))


@query("h19_swap_query", """WITH a AS (SELECT conv_id AS msa_id, CASE WHEN turn = 0 THEN 'Query old' ELSE role || turn END AS header, trim(replace(text, chr(10), '')) AS sequence FROM conversations),
    m AS (SELECT conv_id AS msa_id, conv_id * 10 + k AS member_id, 'mk' || k AS s FROM (SELECT DISTINCT conv_id FROM conversations), range(0, 3) t(k))
    SELECT member_id, 0 AS part, 'query' AS header, upper(s) AS sequence FROM m
    UNION ALL SELECT member_id, 1, header, sequence FROM m JOIN a USING (msa_id) WHERE lower(header) NOT LIKE 'query%' AND sequence <> ''""")
def h19(c):
    a = c.conversations.select(
        F.col("conv_id").alias("msa_id"), F.when(F.col("turn") == 0, "Query old").otherwise(F.concat("role", F.col("turn").cast("string"))).alias("header"),
        F.regexp_replace("text", "\n", "").alias("sequence"),
    )
    m = c.conversations.select(F.col("conv_id").alias("msa_id")).distinct().select("msa_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
    m = m.select("msa_id", (F.col("msa_id") * 10 + F.col("k")).alias("member_id"), F.concat(F.lit("m k"), F.col("k").cast("string")).alias("sequence"))
    return A.swap_query(a, m)


@query("h20_timestamps", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS text, strftime(date_trunc('milliseconds', ts) - INTERVAL 120 SECOND, '%Y-%m-%dT%H:%M:%S.%gZ') AS cutoff FROM events""")
def h20(c):
    text = S.format_utc("ts")
    back = S.parse_utc("text")
    return c.events.select("event_id", text.alias("text")).select("event_id", "text", S.format_utc(S.stale_cutoff(back, 40.0)).alias("cutoff"))


@query("h21_safe_token", """SELECT page_id, trim(regexp_replace(trim(url), '[^A-Za-z0-9._-]+', '_', 'g'), '._-') AS token FROM pages""")
def h21(c):
    return c.pages.select("page_id", S.safe_token("url").alias("token"))
