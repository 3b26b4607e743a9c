"""Sources and sinks. Text inputs are first written from the tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.catalog.fragments import METRICS, SCORED, metric_rows, scored_rows
from bindscope.catalog.sec_e import _ORDER, _POOL, FINAL
from bindscope.functions import scalars as S
from bindscope.operators import campaign as CAMP
from bindscope.operators import interface as I
from bindscope.operators import geometry as GEO
from bindscope.operators import selection as X
from bindscope.operators import structure as T
from bindscope.session import scratch
from bindscope.sources import confidence as C
from bindscope.sources import ledger as LED
from bindscope.sources import sinks as K
from bindscope.sources import structures as ST
from bindscope.sources import tables as TAB
from bindscope.sources import text as TX


def per_file(df, key, order, line, path):
    """A packed table with one text per key, lines in order."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line.alias("l")))), lambda x: x["l"]), "\n")
    name = F.concat(F.lit(f"/data/{key}="), F.col(key).cast("string"), F.lit("/model.txt"))
    ST.pack_files(df.groupBy(key).agg(body.alias("text")).select(name.alias("path"), "text"), path)
    return path


def with_key(df, key):
    return df.withColumn(key, F.regexp_extract("path", f"{key}=(\\d+)", 1).cast("bigint"))


@query("a1_read_ledger", """SELECT candidate_id, shard_id, candidate_index, designed_sequence, binder_chain_id, status, sequence_path, strftime(created_at, '%Y-%m-%d') AS created, NULL::varchar AS error_message FROM v_candidates""")
def a1(c):
    path = scratch(c.spark, "ledger")
    LED.write_ledger({"candidates": c.v_candidates}, path)
    cand = LED.read_ledger(c.spark, path, ["candidates"])["candidates"]
    return cand.select(
        "candidate_id", "shard_id", "candidate_index", "designed_sequence", "binder_chain_id", "status", "sequence_path",
        F.date_format("created_at", "yyyy-MM-dd").alias("created"), "error_message",
    )


_LEDGER = {
    "campaign": "(SELECT n_nationkey AS id, cast(3 AS bigint) AS schema_version, n_name AS config_hash, cast(n_regionkey AS varchar) AS resolved_config_json FROM nation)",
    "shards": "v_shards", "candidates": "v_candidates", "critic_metrics": "v_critic", "validation_tasks": "v_tasks", "validation_structures": "v_samples",
    "validation_msa_jobs": "v_jobs", "validation_msa_job_candidates": "v_deps", "attempts": "v_attempts",
}


def _filled(table: str) -> str:
    names = ", ".join(f"'{name}'" for name in LED.column_names(table))
    return (f"SELECT '{table}' AS table_name, n AS column_name, count(*) AS filled FROM (UNPIVOT (SELECT COLUMNS(lambda c: c IN ({names}))::varchar FROM {_LEDGER[table]}) "
            "ON COLUMNS(*) INTO NAME n VALUE v) GROUP BY n")


@query("a1_ledger_tables", " UNION ALL ".join(_filled(t) for t in LED.COLUMNS))
def a1t(c):
    """All nine tables written and read back: how many cells of each column are filled."""
    held = {t: getattr(c, v) for t, v in _LEDGER.items() if t != "campaign"}
    held["campaign"] = c.nation.select(
        F.col("n_nationkey").alias("id"), F.lit(3).alias("schema_version"), F.col("n_name").alias("config_hash"), F.col("n_regionkey").cast("string").alias("resolved_config_json")
    )
    path = scratch(c.spark, "ledger")
    LED.write_ledger(held, path)
    parts = []
    for name, df in LED.read_ledger(c.spark, path).items():
        counts = df.agg(*[F.count(f"`{x}`").alias(x) for x in df.columns])
        said = F.array(*[F.struct(F.lit(x).alias("column_name"), F.col(f"`{x}`").alias("filled")) for x in df.columns])
        parts.append(counts.select(F.lit(name).alias("table_name"), F.inline(said)))
    return CAMP.union_all(parts).filter("filled > 0")


@query("a2_decode_metrics_strict", """SELECT candidate_id, critic_name, coalesce(len(json_keys(nullif(metrics_json, ''))), 0)::int AS keys, nullif(metrics_json, '') ->> '$.plddt' AS plddt FROM v_critic""")
def a2(c):
    d = c.v_critic.withColumn("d", S.decode_metrics("metrics_json", F.concat_ws(":", "candidate_id", "critic_name")))
    return d.select("candidate_id", "critic_name", F.size("d").alias("keys"), F.try_element_at("d", F.lit("plddt")).alias("plddt"))


@query("a3_decode_lenient", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN props ->> '$.k' END AS k, CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 0 END::int AS items FROM events""")
def a3(c):
    k = F.col("event_id") % 3
    doc = F.when(k == 0, F.col("props")).when(k == 1, F.concat(F.lit("["), F.col("props"), F.lit("]"))).otherwise(F.concat(F.lit("{broken "), F.col("props")))
    arr = F.when(k == 1, F.concat(F.lit('["a","","'), F.col("event_type"), F.lit('",null]'))).otherwise(F.col("props"))
    return c.events.select(
        "event_id", F.try_element_at(S.decode_metrics(doc, "event_id", lenient=True), F.lit("k")).alias("k"), F.size(S.decode_list(arr)).alias("items")
    )


def _pdb(c):
    fixed = lambda n: F.lpad(S.fixed_text(n, 3), 8, " ")
    serial = F.lpad((F.col("residue") + 1).cast("string"), 5, " ")
    seq = F.lpad((F.col("residue") + 1).cast("string"), 4, " ")
    name = F.when(F.col("residue") % 5 == 4, "HOH").when(F.col("residue") % 2 == 0, "GLY").otherwise("LEU")
    line = F.concat(F.lit("ATOM  "), serial, F.lit("  CA  "), name, F.lit(" "), F.col("chain"), seq, F.lit("    "), fixed("x"), fixed("y"), fixed("z"), F.lit("  1.00 50.00           C"))
    body = per_file(c.v_atoms, "structure_id", F.col("residue"), line, scratch(c.spark, "pdb"))
    return body


@query("a4_read_pdb_atoms", """SELECT structure_id, residue + 1 AS number, chain, CASE WHEN residue % 2 = 0 THEN 'GLY' ELSE 'LEU' END AS res_name, cast(printf('%.3f', x) AS double) AS x, cast(printf('%.3f', z) AS double) AS z
    FROM v_atoms WHERE residue % 5 <> 4""")
def a4(c):
    atoms = with_key(ST.read_pdb_atoms(c.spark, _pdb(c), packed=True), "structure_id")
    return atoms.select("structure_id", F.col("auth_seq_id").cast("bigint").alias("number"), "chain", "res_name", "x", "z")


def _cif(c):
    """Two lines per atom, quoted names, a hydrogen beside every fifth atom."""
    head = "\n".join(["data_x", "loop_", *[f"_atom_site.{f}" for f in ("group_PDB", "Cartn_x", "Cartn_y", "Cartn_z", "type_symbol", "label_atom_id", "label_comp_id", "label_asym_id", "label_seq_id")]])
    num = lambda n: S.fixed_text(n, 3)
    row = F.concat(F.lit("ATOM "), num("x"), F.lit(" "), num("y"), F.lit(" "), num("z"), F.lit("\nC \"CA\" LEU "), F.col("chain"), F.lit(" "), (F.col("residue") + 1).cast("string"))
    hyd = F.when(F.col("residue") % 5 == 0, F.concat(F.lit("\nATOM 0 0 0 H 'H1' LEU "), F.col("chain"), F.lit(" "), (F.col("residue") + 1).cast("string"))).otherwise("")
    line = F.concat(F.when(F.col("residue") == 0, F.lit(head + "\n")).otherwise(""), row, hyd, F.when(F.col("residue") == 20, "\n#").otherwise(""))
    return per_file(c.v_atoms, "structure_id", F.col("residue"), line, scratch(c.spark, "cif"))


@query("a5_read_mmcif_atoms", """SELECT structure_id, residue, chain, 'CA' AS atom_name, cast(printf('%.3f', x) AS double) AS x, cast(printf('%.3f', y) AS double) AS y FROM v_atoms""")
def a5(c):
    atoms = with_key(ST.read_mmcif_atoms(c.spark, _cif(c), packed=True), "structure_id")
    return atoms.select("structure_id", "residue", "chain", "atom_name", "x", "y")


@query("a6_read_polymer_register", """SELECT structure_id, chain, row_number() OVER (PARTITION BY structure_id, chain ORDER BY residue) AS number, CASE residue % 3 WHEN 0 THEN 'G' ELSE 'L' END AS letter FROM v_atoms""")
def a6(c):
    name = F.when(F.col("residue") % 3 == 0, "GLY").otherwise("LEU")
    line = F.concat(F.lit("SEQRES   1 "), F.col("chain"), F.lit("   21  "), name, F.lit(" UNK"))
    path = per_file(c.v_atoms, "structure_id", F.col("residue"), line, scratch(c.spark, "seqres"))
    rows = with_key(ST.read_polymer_register(c.spark, path, "seqres", packed=True), "structure_id")
    return rows.select("structure_id", "chain", F.col("number").cast("bigint").alias("number"), "letter")


@query("a7_read_fasta", """WITH l AS (SELECT msa_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM v_texts),
    t AS (SELECT msa_id, pos, trim(line, E' \\t\\r') AS line FROM l WHERE trim(line, E' \\t\\r') <> ''),
    r AS (SELECT *, sum(CASE WHEN starts_with(line, '>') THEN 1 ELSE 0 END) OVER (PARTITION BY msa_id ORDER BY pos) AS rec FROM t),
    g AS (SELECT msa_id, rec, max(CASE WHEN starts_with(line, '>') THEN trim(substr(line, 2)) END) AS header, coalesce(string_agg(line, '' ORDER BY pos) FILTER (NOT starts_with(line, '>')), '') AS sequence FROM r WHERE rec > 0 GROUP BY 1, 2)
    SELECT msa_id, header, arg_max(sequence, rec) AS sequence FROM g WHERE header <> '' GROUP BY 1, 2""")
def a7(c):
    return TX.read_fasta(c.v_texts, "msa_id", "text").select("msa_id", "header", "sequence")


@query("a8_read_confidence", """SELECT vec_id AS structure_id, i, j, round(abs(cast(embedding[i * 8 + j + 1] AS double)) * 1000) / 100 AS pae FROM (SELECT *, unnest(range(0, 8)) AS j FROM (SELECT vec_id, embedding, unnest(range(0, 8)) AS i FROM embeddings) a) b""")
def a8(c):
    """The 64 numbers of each vector as an 8 x 8 matrix file; key spelling varies."""
    cells = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.round(F.abs(F.get("embedding", i * 8 + j).cast("double")) * 1000) / 100))
    key = F.when(F.col("vec_id") % 2 == 0, "pae").otherwise("token_pair_pae")
    text = F.concat(F.lit('{"'), key, F.lit('":'), F.to_json(cells), F.lit(',"atom_plddts":[0.5,0.75]}'))
    path = scratch(c.spark, "confidence")
    name = F.concat(F.lit("/data/vec_id="), F.col("vec_id").cast("string"), F.lit("/full_data.json"))
    ST.pack_files(c.embeddings.select(name.alias("path"), text.alias("text")), path)
    files = with_key(ST.read_files(c.spark, path, packed=True), "vec_id")
    pae, _ = C.parse_confidence(files, "vec_id", "text", "af3")
    return pae.select(F.col("vec_id").alias("structure_id"), "i", "j", "pae")


def confidence_documents(c):
    """A document per vector, of three layouts by turns. Eight tokens: residues 1..3 of chain A,
    a ligand atom, residues 1..4 of chain B; a residue has the atoms N and CA."""
    at = lambda k: F.abs(F.get("embedding", k).cast("double"))
    listed = lambda n, of: F.to_json(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), of))
    cells = listed(8, lambda i: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.round(at(i * 8 + j) * 1000) / 100))
    pair = lambda k: F.regexp_extract(F.to_json(F.array(F.round(at(F.lit(k)) * 1000) / 1000)), r"\[(.*)\]", 1)
    percent, share = (lambda k: F.round(at(k) * 1000) / 10), (lambda k: F.round(at(k) * 1000) / 1000)
    af3 = F.concat(F.lit('{"pae":'), cells, F.lit(',"atom_plddts":'), listed(15, percent), F.lit(',"chain_pair_iptm":[[null,'), pair(20), F.lit("],["), pair(21), F.lit(",null]]}"))
    af2 = F.concat(F.lit('{"predicted_aligned_error":'), cells, F.lit(',"plddt":'), listed(8, percent), F.lit("}"))
    boltz = F.concat(F.lit('{"pae":'), cells, F.lit(',"plddt":'), listed(8, share), F.lit(',"pair_chains_iptm":{"0":{"1":'), pair(20), F.lit('},"1":{"0":'), pair(21), F.lit("}}}"))
    text = F.when(F.col("vec_id") % 3 == 0, af3).when(F.col("vec_id") % 3 == 1, af2).otherwise(boltz)
    path = scratch(c.spark, "confidence")
    name = F.concat(F.lit("/data/vec_id="), F.col("vec_id").cast("string"), F.lit("/confidence.json"))
    ST.pack_files(c.embeddings.select(name.alias("path"), text.alias("text")), path)
    return C.read_documents(with_key(ST.read_files(c.spark, path, packed=True), "vec_id"), "vec_id", "text")


def tokens(c):
    """Tokens that are residues, and the atoms of all."""
    t = F.explode(F.array(*[F.struct(F.lit(k).alias("token"), F.lit("A" if k < 3 else "B").alias("chain"), F.lit(k + 1 if k < 3 else k - 3).alias("residue")) for k in range(8) if k != 3]))
    rows = c.embeddings.select("vec_id", t.alias("t")).select("vec_id", "t.*")
    start = F.col("token") * 2 - F.when(F.col("token") > 3, 1).otherwise(0)
    atoms = rows.select("vec_id", "chain", "residue", F.posexplode(F.array(F.lit("N"), F.lit("CA"))).alias("k", "atom_name"), start.alias("start"))
    return rows, atoms.select("vec_id", (F.col("start") + F.col("k")).alias("ordinal"), "chain", "residue", "atom_name")


_TOKENS = """t AS (SELECT k AS token, CASE WHEN k < 3 THEN 'A' ELSE 'B' END AS chain, CASE WHEN k < 3 THEN k + 1 ELSE k - 3 END AS residue FROM range(0, 8) r(k) WHERE k <> 3)"""


@query("a8_matrix_rows", f"""WITH {_TOKENS} SELECT vec_id AS structure_id, a.chain AS chain_i, b.chain AS chain_j, cast(a.residue AS bigint) AS i, cast(b.residue AS bigint) AS j,
    round(abs(cast(embedding[a.token * 8 + b.token + 1] AS double)) * 1000) / 100 AS pae FROM embeddings, t a, t b WHERE a.chain <> b.chain""")
def a8m(c):
    rows = I.pae_blocks(C.matrix_rows(confidence_documents(c), tokens(c)[0], "vec_id"))
    cells = rows.select("structure_id", "chain_i", "chain_j", "i", "first_j", F.posexplode("paes").alias("k", "pae"))
    return cells.select("structure_id", "chain_i", "chain_j", "i", (F.col("first_j") + F.col("k")).alias("j"), "pae")


@query("a8_residue_plddt", f"""WITH {_TOKENS} SELECT vec_id, chain, cast(residue AS int) AS residue,
    round(round(abs(cast(embedding[CASE WHEN vec_id % 3 = 0 THEN token * 2 + CASE WHEN token > 3 THEN 0 ELSE 1 END ELSE token END + 1] AS double)) * 1000) / 10, 6) AS plddt FROM embeddings, t""")
def a8p(c):
    out = C.residue_plddt(confidence_documents(c), *tokens(c), "vec_id")
    return out.select("vec_id", "chain", "residue", F.round("plddt", 6).alias("plddt"))


@query("a8_chain_pair_iptm", """SELECT vec_id AS structure_id, unnest(['A', 'B']) AS chain_a, unnest(['B', 'A']) AS chain_b,
    unnest([round(abs(cast(embedding[21] AS double)) * 1000) / 1000, round(abs(cast(embedding[22] AS double)) * 1000) / 1000]) AS value FROM embeddings WHERE vec_id % 3 <> 1""")
def a8c(c):
    chains = c.embeddings.select("vec_id", F.posexplode(F.array(F.lit("A"), F.lit("B"))).alias("ordinal", "chain"))
    return C.chain_pair_iptm(confidence_documents(c), chains, "vec_id")


@query("a9_pair_outputs", """SELECT l_suppkey AS seed, l_linenumber::bigint AS sample_rank, 'out/c' || l_orderkey || '/seed_' || l_suppkey || '/predictions/x_summary_confidence_sample_' || l_linenumber || '.json' AS summary,
    CASE WHEN l_linenumber % 3 <> 0 THEN 'out/c' || l_orderkey || '/seed_' || l_suppkey || '/predictions/x_full_data_sample_' || l_linenumber || '.json' END AS "full",
    'out/c' || l_orderkey || '/seed_' || l_suppkey || '/predictions/x_sample_' || l_linenumber || '.cif' AS cif FROM (SELECT DISTINCT l_orderkey, l_suppkey, l_linenumber FROM lineitem) WHERE l_linenumber % 4 <> 0""")
def a9(c):
    n = F.col("l_linenumber")
    base = F.concat(F.lit("out/c"), F.col("l_orderkey").cast("string"), F.lit("/seed_"), F.col("l_suppkey").cast("string"), F.lit("/predictions/x_"))
    num = n.cast("string")
    names = F.array_compact(F.array(
        F.concat(base, F.lit("summary_confidence_sample_"), num, F.lit(".json")),
        F.when(n % 3 != 0, F.concat(base, F.lit("full_data_sample_"), num, F.lit(".json"))),
        F.when(n % 4 != 0, F.concat(base, F.lit("sample_"), num, F.lit(".cif"))),
    ))
    inv = c.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber").distinct().select(F.explode(names).alias("path"))
    return TAB.pair_outputs(inv).select("seed", "sample_rank", "summary", "full", "cif")


@query("a10_framework_panel", """SELECT 'fw_' || p_partkey AS canonical, unnest(['fw_' || p_partkey, 'alias_' || p_partkey, lower(p_brand) || '_' || p_partkey]) AS alias FROM part""")
def a10(c):
    path = scratch(c.spark, "frameworks")
    name = F.concat(F.lit("fw_"), F.col("p_partkey").cast("string"))
    c.part.select(
        name.alias("id"), name.alias("canonical_name"),
        F.array(F.concat(F.lit(" Alias_"), F.col("p_partkey").cast("string")), F.concat_ws("_", "p_brand", F.col("p_partkey").cast("string"))).alias("aliases"),
        F.lit("vhh").alias("modality"), F.lit("A{cdr1}B").alias("template"),
        F.create_map(F.lit("cdr1"), F.struct(F.lit(3).alias("min"), F.col("p_size").alias("max"))).alias("cdr_lengths"),
    ).write.json(path)
    return TAB.require_unique_aliases(TAB.alias_index(TAB.framework_dim(c.spark, path))).select("canonical", "alias")


@query("a11_read_msa_map", """SELECT c_name AS target_name, nullif(substr(c_mktsegment, 1, 1), 'B') AS label, upper(c_mktsegment) AS sequence, NULL::varchar AS pairing_path, 'msa/' || c_custkey AS msa_dir FROM customer""")
def a11(c):
    path = scratch(c.spark, "msa_map")
    label = F.when(F.col("c_mktsegment").startswith("B"), "").otherwise(F.substring("c_mktsegment", 1, 1))
    c.customer.select(
        F.col("c_name").alias(" Name "), label.alias("Chain"), F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("SEQUENCE"),
        F.concat(F.lit("msa/"), F.col("c_custkey").cast("string")).alias("msa_path"),
    ).write.option("header", True).csv(path)
    return TAB.read_msa_map(c.spark, path).select("target_name", "label", "sequence", "pairing_path", "msa_dir")


@query("a12_read_ranked_csv", """SELECT o_orderkey::varchar AS rank, o_orderpriority AS candidate_id FROM orders""")
def a12(c):
    path = scratch(c.spark, "ranked")
    rows = c.orders.select(F.col("o_orderkey").alias("rank"), F.col("o_orderpriority").alias("candidate_id"))
    meta = c.orders.agg(F.max("o_orderkey").cast("string").alias("value")).select(F.lit(0).alias("position"), F.lit("last").alias("key"), "value")
    K.write_report_csv(rows, path, meta)
    return TAB.read_ranked_csv(c.spark, path, ["rank", "candidate_id"])


@query("a13_format_report", """SELECT validation_id, coalesce(regexp_replace(printf('%.3f', iptm), '\\.?0+$', ''), '') AS iptm, coalesce(regexp_replace(printf('%.3f', rmsd / 3), '\\.?0+$', ''), '') AS rmsd, coalesce(selection_rank::varchar, '') AS selection_rank,
    CASE WHEN iptm IS NULL THEN '' WHEN iptm > 0.5 THEN 'true' ELSE 'false' END AS strong FROM v_tasks""")
def a13(c):
    rows = c.v_tasks.select("validation_id", "iptm", (F.col("rmsd") / 3).alias("rmsd"), "selection_rank", (F.col("iptm") > 0.5).alias("strong"))
    return K.format_report(rows)


@query("a14_report_metadata", f"""WITH {METRICS} SELECT 0 AS position, 'target_name' AS key, min(design_metrics_json ->> '$.target_name') AS value FROM cm UNION ALL SELECT 1, 'binder_scaffold', min(lower(trim(design_metrics_json ->> '$.binder_scaffold'))) FROM cm
    UNION ALL SELECT 2, 'frameworks', string_agg(DISTINCT framework, ';' ORDER BY framework) FROM cm UNION ALL SELECT 3, 'num_designs', count(DISTINCT candidate_id)::varchar FROM cm UNION ALL SELECT 4, 'critic', string_agg(DISTINCT critic_name, ';' ORDER BY critic_name) FROM cm""")
def a14(c):
    return K.report_metadata(metric_rows(c)).select("position", "key", "value")


_CONFIG = """'{"target":{"name":' || CASE WHEN n_nationkey % 4 = 0 THEN 'null' ELSE '"T' || n_nationkey || '"' END || '},"binder":{"scaffold":' ||
    CASE WHEN n_nationkey % 3 = 0 THEN 'null' ELSE '"vhh"' END || CASE WHEN n_nationkey % 5 = 0 THEN ',"frameworks":["fx",{"name":"fy"},3]' WHEN n_nationkey % 5 = 1 THEN ',"framework":{"name":"fz"}' ELSE '' END ||
    '},"campaign":{"num_designs":' || (n_nationkey * 10) || CASE WHEN n_nationkey % 2 = 0 THEN ',"steps":[5,6],"critics":["k2","k1"]' ELSE ',"steps":75' END || '},"loss":{' ||
    CASE WHEN n_nationkey % 3 = 1 THEN '"binder_target_contact_mode":"mosaic_cdr","mosaic_cdr_contact_weight":0.5,' ELSE '"binder_target_contact_mode":"all",' END ||
    '"target_geometry_drift":{' || CASE n_nationkey % 4 WHEN 0 THEN '' WHEN 1 THEN '"enabled":false,"weight":2' WHEN 2 THEN '"enabled":true,"weight":2,"tolerance_angstrom":1.5'
    ELSE '"enabled":true,"regions":{"B":["1-5",9],"A":"all"}' END || '}}}'"""
_FIRST = """min(target) AS target, min(scaffold) AS scaffold, string_agg(DISTINCT m.framework, ';' ORDER BY m.framework) AS fw, string_agg(DISTINCT critic_name, ';' ORDER BY critic_name) AS critic"""


@query("a14_campaign_metadata", f"""WITH {METRICS}, g AS (SELECT h.campaign_id, {_FIRST} FROM (SELECT candidate_id, critic_name, framework, design_metrics_json ->> '$.target_name' AS target,
      CASE lower(trim(design_metrics_json ->> '$.binder_scaffold')) WHEN 'vhh' THEN 'vhh' ELSE lower(trim(design_metrics_json ->> '$.binder_scaffold')) END AS scaffold FROM cm) m
      JOIN v_candidates c USING (candidate_id) JOIN v_shards h USING (shard_id) GROUP BY 1),
    d AS (SELECT n_nationkey AS campaign_id, n_nationkey AS k, {_CONFIG} AS c FROM nation),
    v AS (SELECT d.campaign_id, unnest([
      {{'p': 0, 'k': 'target_name', 'v': coalesce(c ->> '$.target.name', target)}}, {{'p': 1, 'k': 'binder_scaffold', 'v': coalesce(c ->> '$.binder.scaffold', scaffold)}},
      {{'p': 2, 'k': 'frameworks', 'v': CASE k % 5 WHEN 0 THEN 'fx;fy' WHEN 1 THEN 'fz' ELSE fw END}}, {{'p': 3, 'k': 'num_designs', 'v': c ->> '$.campaign.num_designs'}},
      {{'p': 4, 'k': 'steps', 'v': c ->> '$.campaign.steps'}}, {{'p': 5, 'k': 'critic', 'v': CASE WHEN k % 2 = 0 THEN 'k2;k1' ELSE critic END}},
      {{'p': 6, 'k': 'binder_target_contact_mode', 'v': CASE WHEN k % 3 = 1 THEN 'mosaic_cdr' END}}, {{'p': 7, 'k': 'mosaic_cdr_contact_weight', 'v': CASE WHEN k % 3 = 1 THEN '0.5' END}},
      {{'p': 10, 'k': 'target_geometry_drift_enabled', 'v': c ->> '$.loss.target_geometry_drift.enabled'}},
      {{'p': 11, 'k': 'target_geometry_drift_weight', 'v': CASE WHEN k % 4 = 2 THEN '2' END}}, {{'p': 12, 'k': 'target_geometry_drift_tolerance_angstrom', 'v': CASE WHEN k % 4 = 2 THEN '1.5' END}},
      {{'p': 14, 'k': 'target_geometry_drift_regions', 'v': CASE k % 4 WHEN 2 THEN 'all' WHEN 3 THEN 'A:all;B:1-5+9' END}}]) AS t FROM d LEFT JOIN g USING (campaign_id))
    SELECT campaign_id, t.p::int AS position, t.k AS key, t.v AS value FROM v WHERE t.v IS NOT NULL AND t.v <> ''""")
def a14c(c):
    text = c.nation.selectExpr("n_nationkey AS campaign_id", _CONFIG + " AS resolved_config_json")
    owner = c.v_candidates.select("candidate_id", "shard_id").join(c.v_shards.select("shard_id", "campaign_id"), "shard_id")
    raw = metric_rows(c).join(owner, "candidate_id")
    scaffold = F.lower(F.trim(F.get_json_object("design_metrics_json", "$.binder_scaffold")))
    named = c.v_candidates.select("candidate_id", scaffold.alias("binder_scaffold"))
    return K.campaign_metadata(text, raw.drop("binder_scaffold").join(named, "candidate_id"), "campaign_id")


@query("a15_summary_json", """SELECT '{"a_status":"' || status || '","n":' || count(*) || ',"z_first":"' || min(validation_id) || '"}' AS value FROM v_tasks GROUP BY status""")
def a15(c):
    agg = c.v_tasks.groupBy(F.col("status").alias("a_status")).agg(F.min("validation_id").alias("z_first"), F.count(F.lit(1)).alias("n"))
    path = scratch(c.spark, "summary")
    K.write_summary(agg, path)
    return c.spark.read.text(path)


@query("a16_write_by_model", """SELECT validation_id, model_name, replace(model_name, '-', '_') AS validator_slug FROM v_tasks""")
def a16(c):
    path = scratch(c.spark, "by_model")
    K.write_by_model(c.v_tasks.select("validation_id", "model_name"), path)
    return c.spark.read.parquet(path).select("validation_id", "model_name", "validator_slug")


@query("a17_fasta_lines", """SELECT '>' || candidate_id || chr(10) || substr(s, 1, 20) || chr(10) || substr(s, 21) AS value FROM (SELECT candidate_id, designed_sequence AS s FROM v_candidates)""")
def a17(c):
    lower = c.v_candidates.select("candidate_id", F.lower("designed_sequence").alias("s"))
    return TX.to_fasta_lines(lower, "candidate_id", "s", 20)


@query("a18_selected_manifest", f"""WITH {METRICS}, {_POOL} SELECT rank, candidate_id, critic_name, file_name FROM (SELECT row_number() OVER (ORDER BY {_ORDER}) AS rank, candidate_id, critic_name, string_split(structure_path, '/')[-1] AS file_name FROM pool) WHERE rank <= 84""")
def a18(c):
    return X.selected_manifest(X.select_designs(metric_rows(c), 100, 0.3), 84).select("rank", "candidate_id", "critic_name", "file_name")


@query("a19_paired_topk_manifest", f"""WITH {SCORED}, {FINAL}, e AS (SELECT *, row_number() OVER (ORDER BY final_rank) AS rn FROM fin WHERE ranking_eligible AND source_structure_path IN (SELECT path FROM v_inventory) AND validated_structure_path IN (SELECT path FROM v_inventory))
    SELECT final_rank, candidate_id, 'critic/rank' || lpad(final_rank::varchar, 4, '0') || '_' || candidate_id || '_critic.pdb' AS critic_copy,
    model_name || '/rank' || lpad(final_rank::varchar, 4, '0') || '_' || candidate_id || '_' || model_name || '.cif' AS validator_copy FROM e WHERE rn <= 84""")
def a19(c):
    # Only eligible rows are numbered, with the columns that the manifest needs.
    eligible = scored_rows(c).filter("ranking_eligible")
    ranked = X.final_rank(eligible, ["candidate_id", "model_name", "ranking_eligible", "source_structure_path", "validated_structure_path"])
    return X.paired_topk_manifest(ranked, c.v_inventory, 84).select("final_rank", "candidate_id", "critic_copy", "validator_copy")


@query("a20_read_inventory", """SELECT 'p_partkey=' || p_partkey % 40 AS folder, count(*) AS files FROM (SELECT DISTINCT p_partkey % 40 AS p_partkey FROM part) GROUP BY 1""")
def a20(c):
    path = scratch(c.spark, "inventory")
    c.part.select((F.col("p_partkey") % 40).alias("p_partkey"), "p_name").repartition("p_partkey").write.partitionBy("p_partkey").csv(path)
    inv = TAB.read_inventory(c.spark, path).filter(~F.col("path").startswith("_"))
    return inv.groupBy(F.regexp_extract("path", "^([^/]*)/", 1).alias("folder")).agg(F.count(F.lit(1)).alias("files"))


@query("a21_write_conditioning", """SELECT structure_id, chain AS chain_i, chain AS chain_j, min(residue) AS start_i, max(residue) + 1 AS end_i, count(*) * count(*) AS pair_count, count(*) * count(*) AS resolved_pairs FROM v_atoms GROUP BY 1, 2""")
def a21(c):
    path = scratch(c.spark, "conditioning")
    K.write_conditioning(GEO.distogram(c.v_atoms), path)
    out = T.conditioning_summary(c.spark.read.parquet(path))
    return out.select("structure_id", "chain_i", "chain_j", "start_i", "end_i", "pair_count", "resolved_pairs")


@query("a22_residue_map", """SELECT chain AS canonical_chain_id, residue::varchar AS model_residue_index_0, 'L' AS sequence_1letter, structure_id::varchar AS input_chain, CASE WHEN residue % 6 = 0 THEN 'false' ELSE 'true' END AS resolved_representative_coord,
    CASE WHEN residue % 6 = 0 THEN '' ELSE printf('%.3f', x) END AS rep_x, CASE WHEN residue % 6 = 0 THEN '' ELSE printf('%.3f', z) END AS rep_z, '' AS label_seq_id FROM v_atoms""")
def a22(c):
    gone = F.col("residue") % 6 == 0
    rows = c.v_atoms.select(
        F.col("chain").alias("canonical_chain_id"), F.col("residue").alias("model_residue_index_0"), F.lit("L").alias("sequence_1letter"),
        F.col("structure_id").alias("input_chain"), *[F.when(~gone, F.col(k)).alias(f"rep_{k}") for k in "xyz"],
    )
    return T.residue_map(rows).select("canonical_chain_id", "model_residue_index_0", "sequence_1letter", "input_chain", "resolved_representative_coord", "rep_x", "rep_z", "label_seq_id")


@query("j2_tokenise_cif", """SELECT structure_id, count(*) AS atoms FROM v_atoms GROUP BY 1""")
def j2(c):
    files = ST.read_files(c.spark, _cif(c), packed=True)
    raw = with_key(ST.cif_category(files, "atom_site", ST.ATOM_FIELDS), "structure_id")
    return raw.filter("type_symbol <> 'H'").groupBy("structure_id").agg(F.count(F.lit(1)).alias("atoms"))
