"""Set operations, merges, ledger state jobs and constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.catalog.sec_d_ledger import _STATUS_TABLES, tables
from bindscope.functions import scalars as S
from bindscope.operators import ledger as L
from bindscope.operators import merge as M
from bindscope.operators import msa as A
from bindscope.operators import quality as Q
from bindscope.operators import state as ST

NOW_SQL = "timestamp '2024-06-01 00:00:00'"


def now():
    return F.expr("timestamp_ntz '2024-06-01 00:00:00'")


@query("g1_insert_new", """WITH t AS (SELECT candidate_id, status FROM v_candidates WHERE status = 'completed'), r AS (SELECT candidate_id, 'planned' AS status FROM v_candidates)
    SELECT * FROM t UNION ALL SELECT * FROM r WHERE candidate_id NOT IN (SELECT candidate_id FROM t)""")
def g1(c):
    target = c.v_candidates.filter("status = 'completed'").select("candidate_id", "status")
    return M.insert_new(target, c.v_candidates.select("candidate_id", F.lit("planned").alias("status")), ["candidate_id"])


@query("g2_upsert_candidates", """WITH t AS (SELECT candidate_id, candidate_index, status, created_at AS started_at, 'old' AS error_message FROM v_candidates WHERE framework IS NOT NULL),
    r AS (SELECT candidate_id, -1 AS candidate_index, 'completed' AS status FROM v_candidates WHERE status = 'pending')
    SELECT candidate_id, coalesce(t.candidate_index, r.candidate_index) AS candidate_index, coalesce(r.status, t.status) AS status,
    CASE WHEN r.candidate_id IS NULL THEN t.error_message END AS error_message, strftime(t.started_at, '%Y-%m-%d') AS started FROM t FULL JOIN r USING (candidate_id)""")
def g2(c):
    target = c.v_candidates.filter("framework is not null").select(
        "candidate_id", "candidate_index", "status", F.col("created_at").alias("started_at"), F.lit("old").alias("error_message")
    )
    rows = c.v_candidates.filter("status = 'pending'").select(
        "candidate_id", F.lit(-1).cast("bigint").alias("candidate_index"), F.lit("completed").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("started_at"), F.lit(None).cast("string").alias("error_message"),
    )
    out = M.upsert_candidates(target, rows)
    return out.select("candidate_id", "candidate_index", "status", "error_message", F.date_format("started_at", "yyyy-MM-dd").alias("started"))


@query("g3_upsert_critics", """WITH t AS (SELECT candidate_id, critic_name, status, iptm, attempt_count FROM v_critic WHERE status <> 'failed'),
    r AS (SELECT candidate_id, critic_name, 'completed' AS status, 0.5::double AS iptm FROM v_critic WHERE iptm IS NULL OR iptm < 0.4)
    SELECT candidate_id, critic_name, coalesce(r.status, t.status) AS status, CASE WHEN r.status IS NULL THEN t.iptm ELSE r.iptm END AS iptm,
    CASE WHEN r.status IS NULL THEN t.attempt_count ELSE coalesce(t.attempt_count + 1, 1) END AS attempt_count FROM t FULL JOIN r USING (candidate_id, critic_name)""")
def g3(c):
    cols = ["candidate_id", "critic_name", "status", "iptm", "attempt_count"]
    target = c.v_critic.filter("status <> 'failed'").select(*cols)
    rows = c.v_critic.filter("iptm is null or iptm < 0.4").select("candidate_id", "critic_name", F.lit("completed").alias("status"), F.lit(0.5).alias("iptm"))
    return M.upsert_critics(target, rows)


@query("g4_upsert_samples", """WITH t AS (SELECT validation_id, structure_id, status, scoped_iptm FROM v_samples WHERE status = 'rejected'),
    r AS (SELECT validation_id, structure_id, 'passing' AS status, try_cast(metrics_json ->> '$.validation_iptm' AS double) AS scoped_iptm FROM v_samples WHERE ranking_score < 0.5)
    SELECT validation_id, structure_id, coalesce(r.status, t.status) AS status, CASE WHEN r.status IS NULL THEN t.scoped_iptm ELSE r.scoped_iptm END AS scoped_iptm FROM t FULL JOIN r USING (validation_id, structure_id)""")
def g4(c):
    target = c.v_samples.filter("status = 'rejected'").select("validation_id", "structure_id", "status", "scoped_iptm")
    rows = c.v_samples.filter("ranking_score < 0.5").select("validation_id", "structure_id", F.lit("passing").alias("status"), "metrics_json")
    return M.upsert_samples(target, rows, "metrics_json", {"scoped_iptm": ("scoped_iptm", "validation_iptm", "iptm")})


@query("g5_merge_metadata", """SELECT s_suppkey, 'a=1,b=' || s_suppkey || ',c=' || s_nationkey AS keep_old, 'a=' || s_nationkey || ',b=' || s_suppkey || ',c=' || s_nationkey AS keep_new FROM supplier""")
def g5(c):
    a = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.col("s_suppkey").cast("string"))
    b = F.create_map(F.lit("a"), F.col("s_nationkey").cast("string"), F.lit("c"), F.col("s_nationkey").cast("string"))
    show = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return c.supplier.select("s_suppkey", show(S.merge_metadata(a, b, "first")).alias("keep_old"), show(S.merge_metadata(a, b, "second")).alias("keep_new"))


@query("g6_unique_texts", """SELECT o_orderkey, array_to_string(list_filter([o_orderstatus, lower(o_orderstatus), CASE WHEN lower(o_orderpriority) = o_orderpriority THEN NULL ELSE substr(o_orderpriority, 1, 1) END], lambda x: x IS NOT NULL), ',') AS texts FROM orders""")
def g6(c):
    arr = F.array("o_orderstatus", F.lit(" "), F.lower("o_orderstatus"), F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1), F.lit(""), F.lit(None).cast("string"))
    return c.orders.select("o_orderkey", F.array_join(S.unique_texts(arr), ",").alias("texts"))


@query("g7_union_counts", "SELECT cast(sum(n) AS bigint) AS total, count(*) AS tables FROM (" + " UNION ALL ".join(f"SELECT count(*) AS n FROM {v}" for v in _STATUS_TABLES.values()) + ")")
def g7(c):
    return L.table_counts(tables(c)).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("tables"))


@query("g8_migrate_dependencies", """SELECT 'c' || l_orderkey AS candidate_id, 'j' || l_suppkey AS msa_job_id, '' AS validation_config_hash, min(l_linenumber * 1000000 + l_partkey) AS reason FROM lineitem GROUP BY 1, 2""")
def g8(c):
    order = F.col("l_linenumber") * 1000000 + F.col("l_partkey")
    deps = c.lineitem.select(
        F.concat(F.lit("c"), F.col("l_orderkey").cast("string")).alias("candidate_id"), F.concat(F.lit("j"), F.col("l_suppkey").cast("string")).alias("msa_job_id"),
        order.alias("reason"), order.alias("row_order"),
    )
    return M.migrate_dependencies(deps, "row_order").select("candidate_id", "msa_job_id", "validation_config_hash", "reason")


@query("g9_config_conflicts", """SELECT c_custkey AS campaign_id, 'h' || c_custkey % 10 AS config_hash, 'h' || c_custkey % 9 AS stored_hash FROM customer WHERE c_custkey % 10 <> c_custkey % 9""")
def g9(c):
    h = lambda n: F.concat(F.lit("h"), (F.col("c_custkey") % n).cast("string")).alias("config_hash")
    return M.config_conflicts(c.customer.select(F.col("c_custkey").alias("campaign_id"), h(9)), c.customer.select(F.col("c_custkey").alias("campaign_id"), h(10)))


# ------------------------------------------------------------------ ledger state
@query("i1_apply_failures", f"""WITH f AS (SELECT validation_id, 'boom ' || k AS m FROM v_tasks WHERE status = 'running' AND model_name = 'model_o')
    SELECT t.validation_id, CASE WHEN m IS NULL THEN status WHEN attempt_count < max_attempts THEN 'pending' ELSE 'failed' END AS status,
    CASE WHEN m IS NULL THEN claim_worker_id END AS claim_worker_id, CASE WHEN m IS NOT NULL AND attempt_count >= max_attempts THEN m END AS error_message,
    strftime(CASE WHEN m IS NOT NULL AND attempt_count >= max_attempts THEN {NOW_SQL} ELSE completed_at END, '%Y-%m-%d') AS completed FROM v_tasks t LEFT JOIN f USING (validation_id)""")
def i1(c):
    tasks = c.v_tasks.withColumn("error_message", F.lit(None).cast("string"))
    failures = c.v_tasks.filter("status = 'running' and model_name = 'model_o'").select("validation_id", F.concat(F.lit("boom "), F.col("k").cast("string")).alias("failed_message"))
    out = ST.apply_failures(tasks, failures, "validation_id", now())
    return out.select("validation_id", "status", "claim_worker_id", "error_message", F.date_format("completed_at", "yyyy-MM-dd").alias("completed"))


@query("i2_sweep_stale", """WITH s AS (SELECT *, coalesce(status = 'running' AND heartbeat_at < timestamp '2024-01-01 00:05:00', false) AS swept FROM v_tasks)
    SELECT validation_id, swept, CASE WHEN NOT swept THEN status WHEN attempt_count < max_attempts THEN 'pending' ELSE 'failed' END AS status,
    CASE WHEN NOT swept THEN claim_worker_id END AS claim_worker_id FROM s""")
def i2(c):
    cutoff = F.expr("timestamp_ntz '2024-01-01 00:05:00'")
    return ST.sweep_stale(c.v_tasks, cutoff, now()).select("validation_id", "swept", "status", "claim_worker_id")


@query("i2_close_stale_attempts", """WITH s AS (SELECT validation_id FROM v_tasks WHERE status = 'running' AND heartbeat_at < timestamp '2024-01-01 00:05:00')
    SELECT attempt_id, CASE WHEN status = 'running' AND validation_id IN (SELECT validation_id FROM s) THEN 'stale' ELSE status END AS status FROM v_attempts""")
def i2b(c):
    swept = ST.sweep_stale(c.v_tasks, F.expr("timestamp_ntz '2024-01-01 00:05:00'"), now()).filter("swept")
    return ST.close_attempts(c.v_attempts, swept, "validation_id", now(), "stale claim").select("attempt_id", "status")


@query("i3_sweep_workers", """WITH d AS (SELECT 'worker_' || (s_suppkey % 3) AS w, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 1000 + s_suppkey % 2 END AS p FROM supplier),
    s AS (SELECT t.*, status = 'running' AND EXISTS (SELECT 1 FROM d WHERE d.w = t.claim_worker_id AND (d.p IS NULL OR d.p = t.claim_pid)) AS swept FROM v_tasks t)
    SELECT validation_id, coalesce(swept, false) AS swept, CASE WHEN NOT coalesce(swept, false) THEN status WHEN attempt_count < max_attempts THEN 'pending' ELSE 'failed' END AS status FROM s""")
def i3(c):
    dead = c.supplier.select(
        F.concat(F.lit("worker_"), (F.col("s_suppkey") % 3).cast("string")).alias("worker_id"),
        F.when(F.col("s_suppkey") % 3 != 0, 1000 + F.col("s_suppkey") % 2).alias("pid"),
    )
    return ST.sweep_workers(c.v_tasks, dead, now()).select("validation_id", "swept", "status")


@query("i4_reopen_missing", """WITH m AS (SELECT msa_job_id, CASE WHEN s_suppkey % 7 = 4 THEN 'msa/' || s_suppkey || '/nonpair.a3m' WHEN s_suppkey % 5 = 4 THEN 'msa/' || s_suppkey || '/pair.a3m' END AS p FROM v_jobs WHERE status = 'ready')
    SELECT j.msa_job_id, CASE WHEN p IS NULL THEN status ELSE 'pending' END AS status, CASE WHEN p IS NULL THEN attempt_count ELSE 0 END AS attempt_count,
    CASE WHEN p IS NULL THEN error_message ELSE 'ready MSA cache artifact missing: ' || p END AS error_message FROM v_jobs j LEFT JOIN m USING (msa_job_id)""")
def i4(c):
    return ST.reopen_missing(c.v_jobs, c.v_inventory).select("msa_job_id", "status", "attempt_count", "error_message")


@query("i5_retry_failed", """WITH n AS (SELECT DISTINCT d.msa_job_id FROM v_deps d JOIN v_candidates c USING (candidate_id) WHERE c.framework = 'fw_3' AND c.status = 'pending')
    SELECT msa_job_id, CASE WHEN status = 'failed' AND msa_job_id IN (SELECT msa_job_id FROM n) THEN 'pending' ELSE status END AS status,
    CASE WHEN status = 'failed' AND msa_job_id IN (SELECT msa_job_id FROM n) THEN 0 ELSE attempt_count END AS attempt_count FROM v_jobs""")
def i5(c):
    named = c.v_candidates.filter("framework = 'fw_3' and status = 'pending'").select("candidate_id")
    return ST.retry_failed(c.v_jobs, c.v_deps, candidate_ids=named).select("msa_job_id", "status", "attempt_count")


_MEMBERS = "SELECT 'job_' || lpad((o_custkey % 100)::varchar, 6, '0') AS msa_job_id, translate(md5((o_orderkey % 400)::varchar), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') AS m, o_orderkey, o_orderstatus FROM orders"


def _members(c):
    return c.orders.select(
        F.concat(F.lit("job_"), F.lpad((F.col("o_custkey") % 100).cast("string"), 6, "0")).alias("msa_job_id"),
        F.translate(F.md5((F.col("o_orderkey") % 400).cast("string")), "0123456789abcdef", "ACDEFGHIKLMNPQRS").alias("member_sequence"), "o_orderstatus",
    )


@query("i6_reopen_with_members", f"""WITH m AS ({_MEMBERS}), old AS (SELECT DISTINCT msa_job_id, m FROM m WHERE o_orderstatus = 'O' OR msa_job_id < 'job_000050'), new AS (SELECT DISTINCT msa_job_id, m FROM m),
    f AS (SELECT DISTINCT msa_job_id FROM (SELECT * FROM new EXCEPT SELECT * FROM old))
    SELECT msa_job_id, CASE WHEN status = 'ready' AND msa_job_id IN (SELECT msa_job_id FROM f) THEN 'pending' ELSE status END AS status FROM v_jobs""")
def i6(c):
    m = _members(c)
    return A.reopen_with_members(c.v_jobs, m.filter("o_orderstatus = 'O' or msa_job_id < 'job_000050'"), m).select("msa_job_id", "status")


@query("i7_check_completion", """WITH b AS (SELECT validation_id, structure_path FROM (SELECT *, row_number() OVER (PARTITION BY validation_id ORDER BY sample_rank) AS rn FROM v_samples) WHERE rn = 1),
    t AS (SELECT validation_id, status, CASE WHEN k % 5 = 0 THEN output_structure_path ELSE structure_path END AS output_structure_path FROM v_tasks JOIN b USING (validation_id))
    SELECT validation_id, output_structure_path FROM t WHERE status = 'completed' AND NOT EXISTS (SELECT 1 FROM v_samples s WHERE s.validation_id = t.validation_id
      AND s.structure_path = t.output_structure_path AND s.metrics_json <> '{}')""")
def i7(c):
    """Each task's chosen structure is its first sample, but for every fifth one, which is recorded nowhere."""
    first = c.v_samples.groupBy("validation_id").agg(F.min_by("structure_path", "sample_rank").alias("first"))
    chosen = F.when(F.col("k") % 5 == 0, F.col("output_structure_path")).otherwise(F.col("first"))
    return ST.check_completion(c.v_tasks.join(first, "validation_id").withColumn("output_structure_path", chosen), c.v_samples)


@query("d38_coalesce_jobs", """WITH r AS (SELECT 'target' AS scope, 'k' || o_custkey % 30 AS cache_key, 'x' AS ctx, o_orderkey AS ord, translate(md5((o_orderkey % 400)::varchar), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') AS m FROM orders)
    SELECT scope, cache_key, 'msa_target_' || substr(sha256(scope || '|' || cache_key || '|' || ctx), 1, 16) AS msa_job_id, min_by(m, ord) AS representative_sequence, count(DISTINCT m) AS member_count FROM r GROUP BY scope, cache_key, ctx""")
def d38(c):
    return A.coalesce_jobs(_requests(c))[0].select("scope", "cache_key", "msa_job_id", "representative_sequence", "member_count")


def _requests(c):
    seq = F.translate(F.md5((F.col("o_orderkey") % 400).cast("string")), "0123456789abcdef", "ACDEFGHIKLMNPQRS")
    return c.orders.select(
        F.lit("target").alias("scope"), F.concat(F.lit("k"), (F.col("o_custkey") % 30).cast("string")).alias("cache_key"), F.lit("x").alias("msa_context_hash"),
        F.col("o_orderkey").alias("request_order"), seq.alias("representative_sequence"), seq.alias("member_sequence"),
    )


@query("d38_job_members", """WITH r AS (SELECT 'k' || o_custkey % 30 AS cache_key, o_orderkey AS ord, translate(md5((o_orderkey % 400)::varchar), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') AS m FROM orders),
    f AS (SELECT cache_key, m, min(ord) AS o FROM r GROUP BY 1, 2) SELECT cache_key, m AS member_sequence, row_number() OVER (PARTITION BY cache_key ORDER BY o, m) AS ordinal FROM f""")
def d38m(c):
    return A.coalesce_jobs(_requests(c))[1].select("cache_key", "member_sequence", "ordinal")


@query("d39_vhh_groups", """WITH s AS (SELECT o_orderkey AS idx, translate(md5((o_orderkey % 4000)::varchar), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') AS sequence,
      '{"chain_class":"vhh","n":' || o_custkey % 60 || '}' AS template_key FROM orders),
    g AS (SELECT template_key, min_by(sequence, idx) AS first_seq, substr(sha256(template_key), 1, 16) AS h FROM s GROUP BY 1)
    SELECT s.idx, g.h AS template_key_hash, CASE WHEN template_key LIKE '%7}' THEN 'CACHED' ELSE first_seq END AS representative FROM s JOIN g USING (template_key)""")
def d39(c):
    key = F.concat(F.lit('{"chain_class":"vhh","n":'), (F.col("o_custkey") % 60).cast("string"), F.lit("}"))
    seqs = c.orders.select(
        F.col("o_orderkey").alias("index"), F.translate(F.md5((F.col("o_orderkey") % 4000).cast("string")), "0123456789abcdef", "ACDEFGHIKLMNPQRS").alias("sequence"), key.alias("template_key")
    )
    cached = seqs.filter("template_key like '%7}'").select(S.short_sha(F.col("template_key"), 16).alias("template_key_hash"), F.lit("CACHED").alias("sequence")).distinct()
    return A.vhh_groups(seqs, cached).select(F.col("index").alias("idx"), "template_key_hash", "representative")


# ------------------------------------------------------------------- constraints
@query("k1_check_domains", """SELECT validation_id AS row_id, unnest(list_filter([CASE WHEN NOT (status IN ('pending', 'running', 'completed', 'failed')) THEN 'status' END,
    CASE WHEN NOT (selection_rank > 0) THEN 'selection_rank' END, CASE WHEN NOT (attempt_count < max_attempts) THEN 'budget' END, CASE WHEN NOT (rmsd >= 0.5) THEN 'rmsd' END], lambda x: x IS NOT NULL)) AS rule FROM v_tasks""")
def k1(c):
    rules = {
        "status": F.col("status").isin("pending", "running", "completed", "failed"), "selection_rank": F.col("selection_rank") > 0,
        "budget": F.col("attempt_count") < F.col("max_attempts"), "rmsd": F.col("rmsd") >= 0.5,
    }
    return Q.expectations(c.v_tasks, F.col("validation_id"), rules)


_RULES = {
    "shards": ("v_shards", "shard_id", {"budget": "attempt_count <= max_attempts", "started": "started_at >= created_at"}),
    "candidates": ("v_candidates", "candidate_id", {"sequence": "length(designed_sequence) > 0", "chain": "binder_chain_id = 'B'"}),
    "critic_metrics": ("v_critic", "structure_path", {"iptm": "iptm BETWEEN 0 AND 0.95", "plddt": "plddt <= 98"}),
    "validation_tasks": ("v_tasks", "validation_id", {"budget": "attempt_count < max_attempts", "ipsae": "ipsae BETWEEN 0 AND 1"}),
    "validation_structures": ("v_samples", "structure_id", {"iptm": "scoped_iptm BETWEEN 0 AND 1", "rank": "sample_rank >= 0"}),
    "validation_msa_jobs": ("v_jobs", "msa_job_id", {"budget": "attempt_count < max_attempts", "message": "status <> 'failed' OR error_message IS NOT NULL"}),
    "attempts": ("v_attempts", "attempt_id", {"ended": "status = 'running' OR ended_at IS NOT NULL", "pid": "pid BETWEEN 1000 AND 1005"}),
}


def _rules_sql(table: str) -> dict[str, str]:
    return {"status": f"status IN ({', '.join(repr(v) for v in Q.STATUS_DOMAINS[table])})"} | _RULES[table][2]


def row_rules(c):
    return {t: (getattr(c, view), Q.domain_rule(t) | {k: F.expr(v) for k, v in rules.items()}) for t, (view, _, rules) in _RULES.items()}


@query("k1_audit", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{rule}' AS rule, count(*) AS checked, count(*) FILTER (NOT ({text})) AS broken FROM {_RULES[t][0]}" for t in _RULES for rule, text in _rules_sql(t).items()
))
def k1a(c):
    return Q.audit(row_rules(c))


@query("k1_violations", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {_RULES[t][1]}::varchar AS row_id, '{rule}' AS rule FROM {_RULES[t][0]} WHERE NOT ({text})" for t in _RULES for rule, text in _rules_sql(t).items()
))
def k1v(c):
    return Q.violations(row_rules(c), {t: F.col(key) for t, (_, key, _) in _RULES.items()})


@query("k2_check_unique", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def k2(c):
    return Q.check_unique(c.lineitem, ["l_orderkey", "l_linenumber"])


@query("k3_check_foreign_key", "SELECT attempt_id, validation_id FROM v_attempts a WHERE NOT EXISTS (SELECT 1 FROM v_tasks t WHERE t.validation_id = a.validation_id)")
def k3(c):
    return Q.check_foreign_key(c.v_attempts, c.v_tasks, ["validation_id"]).select("attempt_id", "validation_id")


@query("k4_check_ranges", """WITH r AS (SELECT l_orderkey, l_linenumber, min(l_partkey % 60) AS s, min(l_partkey % 60) + min(l_suppkey % 9) - 1 AS e FROM lineitem GROUP BY 1, 2),
    w AS (SELECT *, lag(s) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS ps, max(e) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM r)
    SELECT l_orderkey, l_linenumber, CASE WHEN s <= 0 OR e <= 0 THEN 'positions must be positive' WHEN e < s THEN 'end must be >= start' WHEN e > 60 THEN 'end is outside the sequence'
      WHEN s < ps THEN 'ranges must appear in sequence order' WHEN s <= far THEN 'range overlaps an earlier one' END AS rule FROM w WHERE rule IS NOT NULL""")
def k4(c):
    start = F.min(F.col("l_partkey") % 60)
    r = c.lineitem.groupBy("l_orderkey", "l_linenumber").agg(start.alias("start"), (start + F.min(F.col("l_suppkey") % 9) - 1).alias("end")).withColumn("length", F.lit(60))
    return Q.check_ranges(r, ["l_orderkey"], "l_linenumber", "length").select("l_orderkey", "l_linenumber", "rule")


@query("k5_check_contiguous", """WITH r AS (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem), t AS (SELECT *, lead(n) OVER (PARTITION BY l_orderkey ORDER BY n) AS nx FROM r)
    SELECT l_orderkey, cast(n AS bigint) AS number, cast(nx AS bigint) AS next_number FROM t WHERE nx - n NOT IN (0, 1)""")
def k5(c):
    rows = c.lineitem.select("l_orderkey", F.col("l_linenumber").cast("string").alias("num"), "l_linenumber").distinct()
    return Q.check_contiguous(rows, ["l_orderkey"], "l_linenumber", "num")


@query("k6_check_hotspots_resolved", """SELECT vec_id AS structure_id, 'A' AS chain, cast(30 AS bigint) AS residue FROM embeddings""")
def k6(c):
    from bindscope.catalog.sec_d_geometry import hotspots

    return Q.check_hotspots_resolved(c.v_atoms, hotspots(c), ["structure_id", "chain", "residue"])


@query("k7_check_pair_mask", f"""SELECT structure_id, cast(221 AS bigint) AS expected_pairs, count(*) FILTER (pae < 10) AS unexpected_pairs FROM v_pae GROUP BY 1""")
def k7(c):
    from bindscope.operators import geometry as G

    own = G.distogram(c.v_atoms).select("structure_id", "i", "j", "mask")
    cross = c.v_pae.select("structure_id", "i", "j", (F.col("pae") < 10).alias("mask"))
    spans = c.v_atoms.groupBy("structure_id", "chain").agg(F.min("residue").alias("start"), (F.max("residue") + 1).alias("end"))
    return Q.check_pair_mask(own.unionByName(cross), spans).select("structure_id", "expected_pairs", "unexpected_pairs")
