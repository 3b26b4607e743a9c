"""Ledger-shaped views over the test tables.

Every view is one SELECT that both Spark SQL and the checking engine accept, so both
sides start from the same rows. ``{name}`` refers to a table or another view;
``@TS[n]@`` is a timestamp ``n`` seconds after 2024-01-01. Where the dialects differ
(array unnesting) a view has two texts.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _pad(expr: str, width: int) -> str:
    text = f"cast({expr} as string)"
    return f"lpad({text}, cast(greatest({width}, length({text})) as int), '0')"


_CAND = "'cand_' || " + _pad("l_orderkey", 8)
_OCAND = "'cand_' || " + _pad("o_orderkey", 8)
_VAL = "'val_' || " + _pad("l_orderkey", 8) + " || '_' || l_linestatus"
_SEQ = "translate(md5(cast({0} as string)), '0123456789abcdef', 'ACDEFGHIKLMNPQRS')"

SHARED: dict[str, str] = {
    "v_shards": f"""
        SELECT 'shard_' || {_pad('c_custkey', 6)} AS shard_id,
               cast(c_nationkey as bigint) AS campaign_id,
               c_custkey AS seed, c_custkey AS batch_index,
               'target_' || cast(c_nationkey as string) AS target_key,
               lower(c_mktsegment) AS binder_key,
               CASE c_custkey % 20 WHEN 0 THEN 'failed' WHEN 1 THEN 'running'
                    WHEN 2 THEN 'pending' WHEN 3 THEN 'cancelled' ELSE 'completed' END AS status,
               CASE WHEN c_custkey % 20 = 1 THEN 'worker_' || cast(c_custkey % 7 as string) END AS claim_worker_id,
               CASE WHEN c_custkey % 20 = 1 THEN 1000 + c_custkey % 7 END AS claim_pid,
               CASE WHEN c_custkey % 20 = 1 AND c_custkey % 40 <> 1
                    THEN @TS[c_custkey % 600]@ END AS heartbeat_at,
               cast(c_custkey % 4 as bigint) AS attempt_count, cast(3 as bigint) AS max_attempts,
               @TS[c_custkey % 1000]@ AS created_at,
               CASE WHEN c_custkey % 20 <> 2 THEN @TS[c_custkey % 1000 + 10]@ END AS started_at,
               CASE WHEN c_custkey % 20 > 3 THEN @TS[c_custkey % 1000 + 500]@ END AS completed_at,
               CASE WHEN c_custkey % 20 = 0 THEN 'out of memory' END AS error_message
        FROM {{customer}}""",
    "v_candidates": f"""
        SELECT {_OCAND} AS candidate_id, 'shard_' || {_pad('o_custkey', 6)} AS shard_id,
               o_orderkey AS candidate_index,
               {_SEQ.format('o_orderkey % 4000')} AS designed_sequence,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'B' END AS binder_chain_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'miniprotein' WHEN 1 THEN 'vhh' ELSE 'scfv' END AS binder_scaffold,
               CASE WHEN o_orderkey % 3 > 0 THEN 'fw_' || cast(o_orderkey % 7 as string) END AS framework,
               CASE WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'completed' END AS status,
               'shards/' || {_pad('o_orderkey', 8)} || '/design.fasta' AS sequence_path,
               '{{{{"target_name":"target ' || cast(o_custkey % 25 as string) || '","binder_scaffold":"'
                 || CASE o_orderkey % 3 WHEN 0 THEN ' Mini_Binder ' WHEN 1 THEN 'vhh' ELSE 'sc_fv' END
                 || '","framework_name":'
                 || CASE WHEN o_orderkey % 3 > 0 THEN '"fw_' || cast(o_orderkey % 7 as string) || '"' ELSE 'null' END
                 || ',"loss":' || cast(o_orderkey % 90 as string) || '.5'
                 || CASE WHEN o_orderkey % 4 = 0 THEN ',"final_loss":null' ELSE '' END
                 || ',"cdr_sequences":{{{{"cdr1":"' || substr(md5(cast(o_orderkey as string)), 1, 6)
                 || '","hcdr1":"' || substr(md5(cast(o_orderkey as string)), 7, 6)
                 || '","hcdr2":"","lcdr3":"' || substr(md5(cast(o_orderkey as string)), 13, 9) || '"}}}}}}}}' AS design_metrics_json,
               o_orderdate AS created_at,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS completed_at
        FROM {{orders}}""",
    "v_critic": f"""
        SELECT candidate_id, 'critic_' || cast(line as string) AS critic_name,
               CASE WHEN (k + line) % 9 = 0 THEN 'failed' WHEN (k + line) % 9 = 1 THEN 'running'
                    ELSE 'completed' END AS status,
               'shards/' || {_pad('k', 8)} || '/critic_' || cast(line as string) || '.pdb' AS structure_path,
               CASE WHEN qmin < 3 THEN NULL ELSE dmax * 10 END AS iptm,
               tmax * 10 AS ptm, qmax * 2 AS plddt,
               qmax / 50 AS distogram_iptm_proxy, qmin / 50 AS cdr_distogram_iptm_proxy,
               CASE WHEN k % 6 = 0 THEN NULL ELSE qmin / 5 END AS hotspot_distance_angstrom,
               cast(5.0 as double) AS hotspot_cutoff,
               CASE WHEN k % 6 = 0 THEN NULL WHEN qmin <= 25 THEN cast(1 as double) ELSE cast(0 as double) END AS hotspot_satisfaction,
               CASE WHEN (k + line) % 50 = 0 THEN '' ELSE
                 '{{{{"iptm_scope":"binder_target","hotspot_contact_cutoff_angstrom":5.0'
                 || CASE WHEN k % 6 = 0 THEN '' ELSE ',"hotspot_min_heavy_atom_distance_min":' || cast(qmin / 5 as string) END
                 || CASE WHEN line % 3 = 0 THEN ',"ptm":null' ELSE '' END
                 || ',"plddt":' || cast(qmax as string) || '}}}}' END AS metrics_json,
               cast(k % 3 as bigint) AS attempt_count, k, line, started_at
        FROM (SELECT {_CAND} AS candidate_id, l_orderkey AS k, l_linenumber AS line,
                     min(l_quantity) AS qmin, max(l_quantity) AS qmax, max(l_discount) AS dmax,
                     max(l_tax) AS tmax, min(l_shipdate) AS started_at
              FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber) g""",
    "v_tasks": f"""
        SELECT validation_id, candidate_id, 'model_' || lower(ls) AS model_name,
               CASE WHEN k % 4 = 0 THEN 'cfg_b' ELSE 'cfg_a' END AS validation_config_hash,
               CASE WHEN k % 500 = 0 THEN NULL ELSE k % 500 END AS selection_rank,
               CASE k % 10 WHEN 0 THEN 'failed' WHEN 1 THEN 'pending' WHEN 2 THEN 'running'
                    WHEN 3 THEN 'skipped' ELSE 'completed' END AS status,
               CASE WHEN k % 10 = 2 THEN 'worker_' || cast(k % 7 as string) END AS claim_worker_id,
               CASE WHEN k % 10 = 2 THEN 1000 + k % 7 END AS claim_pid,
               CASE WHEN k % 20 = 2 THEN @TS[k % 600]@ END AS heartbeat_at,
               cast(k % 4 as bigint) AS attempt_count, cast(3 as bigint) AS max_attempts,
               CASE WHEN k % 13 = 0 THEN NULL ELSE dmax * 10 END AS iptm,
               CASE WHEN k % 11 = 0 THEN NULL WHEN k % 23 = 0 THEN cast(1.5 as double)
                    ELSE qmax / 50 END AS ipsae,
               CASE WHEN k % 17 = 0 THEN NULL ELSE tmax * 50 END AS rmsd,
               qmin / 50 AS ranking_score,
               CASE WHEN k % 19 = 0 THEN '' WHEN k % 7 = 0 THEN 'No' ELSE 'true' END AS validator_passed,
               'validation/' || lower(ls) || CASE WHEN k % 7 = 0 THEN '/rejected/' ELSE '/passing/' END
                 || validation_id || '.cif' AS output_structure_path,
               started_at AS created_at,
               CASE WHEN k % 10 > 3 THEN started_at END AS completed_at, k
        FROM (SELECT {_VAL} AS validation_id, {_CAND} AS candidate_id, l_orderkey AS k,
                     l_linestatus AS ls, max(l_discount) AS dmax, max(l_tax) AS tmax,
                     min(l_quantity) AS qmin, max(l_quantity) AS qmax, min(l_shipdate) AS started_at
              FROM {{lineitem}} GROUP BY l_orderkey, l_linestatus) g""",
    "v_samples": f"""
        SELECT validation_id, validation_id || '_s' || cast(line as string) AS structure_id,
               candidate_id, 'model_' || lower(ls) AS model_name, seed, cast(line as bigint) AS sample_rank,
               CASE WHEN dmax >= 0.05 THEN 'passing' ELSE 'rejected' END AS status,
               'validation/' || lower(ls) || CASE WHEN dmax >= 0.05 THEN '/passing/' ELSE '/rejected/' END
                 || validation_id || '_s' || cast(line as string) || '.cif' AS structure_path,
               CASE WHEN k % 13 = 0 THEN NULL ELSE dmax * 10 END AS scoped_iptm,
               CASE WHEN seed % 11 = 0 THEN NULL ELSE qmax / 50 END AS scoped_ipsae,
               tmax * 10 AS ptm, qmin / 50 AS ranking_score,
               CASE WHEN k % 29 = 0 THEN '{{{{}}}}' ELSE '{{{{"validation_iptm":' || cast(cast(qmax as bigint) as string) || '}}}}' END AS metrics_json,
               started_at AS created_at, k
        FROM (SELECT {_VAL} AS validation_id, {_CAND} AS candidate_id, l_orderkey AS k,
                     l_linestatus AS ls, l_linenumber AS line, min(l_suppkey) AS seed,
                     max(l_discount) AS dmax, max(l_tax) AS tmax, min(l_quantity) AS qmin,
                     max(l_quantity) AS qmax, min(l_shipdate) AS started_at
              FROM {{lineitem}} GROUP BY l_orderkey, l_linestatus, l_linenumber) g""",
    "v_jobs": f"""
        SELECT 'job_' || {_pad('s_suppkey', 6)} AS msa_job_id,
               CASE s_suppkey % 4 WHEN 0 THEN 'target' WHEN 1 THEN 'vhh_binder_group'
                    WHEN 2 THEN 'scfv_binder_group' ELSE 'miniprotein_single_sequence' END AS scope,
               'key_' || cast(s_suppkey as string) AS cache_key,
               'ctx_' || cast(s_suppkey % 2 as string) AS msa_context_hash,
               CASE s_suppkey % 10 WHEN 0 THEN 'failed' WHEN 1 THEN 'running' WHEN 2 THEN 'skipped'
                    WHEN 3 THEN 'pending' ELSE 'ready' END AS status,
               CASE WHEN s_suppkey % 10 = 1 THEN 'worker_' || cast(s_suppkey % 7 as string) END AS claim_worker_id,
               CASE WHEN s_suppkey % 10 = 1 THEN 1000 + s_suppkey % 7 END AS claim_pid,
               CASE WHEN s_suppkey % 10 = 1 THEN @TS[s_suppkey % 600]@ END AS heartbeat_at,
               cast(s_suppkey % 4 as bigint) AS attempt_count, cast(3 as bigint) AS max_attempts,
               CASE WHEN s_suppkey % 3 = 0 THEN @TS[s_suppkey % 900]@ END AS next_eligible_at,
               {_SEQ.format('s_suppkey')} AS representative_sequence,
               '{{{{"pairing_path":"msa/' || cast(s_suppkey as string) || '/pair.a3m","non_pairing_path":"msa/'
                 || cast(s_suppkey as string) || '/nonpair.a3m","more":{{{{"metadata_path":"msa/'
                 || cast(s_suppkey as string) || '/pair.a3m"}}}}}}}}' AS cache_paths_json,
               @TS[s_suppkey % 700]@ AS created_at,
               CASE WHEN s_suppkey % 10 <> 1 AND s_suppkey % 10 <> 3 THEN @TS[s_suppkey % 700 + 60]@ END AS completed_at,
               CASE WHEN s_suppkey % 10 = 0 THEN 'server refused' END AS error_message,
               s_suppkey
        FROM {{supplier}}""",
    "v_deps": f"""
        SELECT DISTINCT {_CAND} AS candidate_id, 'job_' || {_pad('l_suppkey', 6)} AS msa_job_id,
               CASE WHEN l_orderkey % 8 = 0 THEN 'cfg_b' ELSE 'cfg_a' END AS validation_config_hash,
               '' AS reason
        FROM {{lineitem}}""",
    "v_attempts": f"""
        SELECT event_id AS attempt_id, 'val_' || {_pad('event_id', 8)} || '_O' AS validation_id,
               'validation' AS stage,
               CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed'
                    WHEN 'signup' THEN 'cancelled' ELSE 'running' END AS status,
               'worker_' || cast(event_id % 7 as string) AS worker_id, 1000 + event_id % 7 AS pid,
               ts AS started_at,
               CASE WHEN event_type IN ('purchase', 'error', 'signup') THEN ts END AS ended_at
        FROM {{events}}""",
    "v_inventory": """
        SELECT sequence_path AS path, candidate_index % 97 AS size FROM {v_candidates} WHERE candidate_index % 19 <> 0
        UNION ALL SELECT structure_path, k % 97 FROM {v_critic} WHERE k % 13 <> 0
        UNION ALL SELECT output_structure_path, k % 97 FROM {v_tasks} WHERE k % 17 <> 0
        UNION ALL SELECT structure_path, k % 97 FROM {v_samples} WHERE k % 23 <> 0
        UNION ALL SELECT 'shards/stray/' || cast(p_partkey as string) || '.pdb', p_partkey % 97 FROM {part} WHERE p_partkey % 9 = 0
        UNION ALL SELECT 'msa/' || cast(s_suppkey as string) || '/pair.a3m', s_suppkey % 97 FROM {supplier} WHERE s_suppkey % 5 <> 4
        UNION ALL SELECT 'msa/' || cast(s_suppkey as string) || '/nonpair.a3m', s_suppkey % 97 FROM {supplier} WHERE s_suppkey % 7 <> 4""",
    "v_task_events": """
        SELECT event_id, user_id AS task_id, ts,
               CASE event_type WHEN 'signup' THEN 'claim' WHEN 'purchase' THEN 'completed'
                    WHEN 'error' THEN 'failed' ELSE 'heartbeat' END AS kind
        FROM {events}""",
    # Small campaigns for the roll-up: one shard and one candidate each, and planned ones without.
    "v_campaigns": """
        SELECT o_orderkey AS campaign_id, o_orderkey % 2 = 0 AS validation_configured FROM {orders}
        UNION ALL SELECT -s_suppkey, s_suppkey % 3 = 0 FROM {supplier}""",
    "v_campaign_shards": """
        SELECT 'one_' || cast(o_orderkey as string) AS shard_id, o_orderkey AS campaign_id,
               CASE o_orderkey % 20 WHEN 0 THEN 'failed' WHEN 1 THEN 'running' WHEN 2 THEN 'pending' WHEN 3 THEN 'cancelled'
                    WHEN 4 THEN 'skipped' ELSE 'completed' END AS status FROM {orders}""",
    "v_artifacts": """
        SELECT o_orderkey AS campaign_id, 'critic_metrics' AS name FROM {orders} WHERE o_orderkey % 7 <> 1
        UNION ALL SELECT o_orderkey, 'critic_selection' FROM {orders} WHERE o_orderkey % 5 <> 2
        UNION ALL SELECT o_orderkey, 'validation_results' FROM {orders} WHERE o_orderkey % 11 <> 3
        UNION ALL SELECT o_orderkey, 'combined_ranking' FROM {orders} WHERE o_orderkey % 13 <> 4
        UNION ALL SELECT o_orderkey, 'ranking_summary' FROM {orders} WHERE o_orderkey % 17 <> 5""",
    "v_aliases": """
        SELECT 'alias_' || cast(p_partkey as string) AS alias, 'fw_' || cast(p_partkey % 7 as string) AS canonical,
               cast(p_size as bigint) AS min_length, cast(p_size + 20 as bigint) AS max_length
        FROM {part}""",
    "v_texts": """
        SELECT doc_id AS msa_id, '>' || lang || cast(doc_id as string) || chr(10) || text AS text FROM {documents}""",
}

_RESIDUE = """
    vec_id AS structure_id, cast(label as bigint) AS label, r AS residue,
    CASE WHEN r < 11 THEN 'A' ELSE 'B' END AS chain"""
_RES_NAMES = "'ALA,GLY,SER,LEU,GLU,LYS,VAL'"

# (Spark text, checking-engine text)
PAIRED: dict[str, tuple[str, str]] = {
    "v_atoms": (
        f"""SELECT {_RESIDUE},
               cast(embedding[3 * r] as double) * 20 AS x, cast(embedding[3 * r + 1] as double) * 20 AS y,
               cast(embedding[3 * r + 2] as double) * 20 AS z
            FROM {{spread}} LATERAL VIEW explode(sequence(0L, 20L)) t AS r""",
        f"""SELECT {_RESIDUE},
               cast(embedding[3 * r + 1] as double) * 20 AS x, cast(embedding[3 * r + 2] as double) * 20 AS y,
               cast(embedding[3 * r + 3] as double) * 20 AS z
            FROM (SELECT vec_id, embedding, label, unnest(range(0, 21)) AS r FROM {{embeddings}}) t""",
    ),
    "v_residues": (
        f"""SELECT {_RESIDUE}, least(cast(100 as double), 50 + 100 * abs(cast(embedding[3 * r + 2] as double))) AS plddt
            FROM {{spread}} LATERAL VIEW explode(sequence(0L, 20L)) t AS r""",
        f"""SELECT {_RESIDUE}, least(cast(100 as double), 50 + 100 * abs(cast(embedding[3 * r + 3] as double))) AS plddt
            FROM (SELECT vec_id, embedding, label, unnest(range(0, 21)) AS r FROM {{embeddings}}) t""",
    ),
    "v_pae": (
        """SELECT vec_id AS structure_id, i, j, CASE WHEN i < 11 THEN 'A' ELSE 'B' END AS chain_i,
                  CASE WHEN j < 11 THEN 'A' ELSE 'B' END AS chain_j,
                  40 * abs(cast(embedding[3 * i] as double) - cast(embedding[3 * j + 1] as double)) AS pae
           FROM {spread} LATERAL VIEW explode(sequence(0L, 20L)) t AS i
           LATERAL VIEW explode(sequence(0L, 20L)) u AS j WHERE (i < 11) <> (j < 11)""",
        """SELECT vec_id AS structure_id, i, j, CASE WHEN i < 11 THEN 'A' ELSE 'B' END AS chain_i,
                  CASE WHEN j < 11 THEN 'A' ELSE 'B' END AS chain_j,
                  40 * abs(cast(embedding[3 * i + 1] as double) - cast(embedding[3 * j + 2] as double)) AS pae
           FROM (SELECT *, unnest(range(0, 21)) AS j FROM
                 (SELECT vec_id, embedding, unnest(range(0, 21)) AS i FROM {embeddings}) a) b
           WHERE (i < 11) <> (j < 11)""",
    ),
    # The same errors as rows of the matrix; within a chain they are null.
    "v_pae_rows": (
        """SELECT vec_id AS structure_id, CASE WHEN i < 11 THEN 'A' ELSE 'B' END AS chain, i,
                  transform(sequence(0L, 20L), j -> CASE WHEN (i < 11) <> (j < 11)
                    THEN 40 * abs(cast(embedding[cast(3 * i as int)] as double) - cast(embedding[cast(3 * j + 1 as int)] as double)) END) AS errors,
                  array(named_struct('chain', 'A', 'start', 0, 'length', 11, 'first', 0L, 'residues', 11),
                        named_struct('chain', 'B', 'start', 11, 'length', 10, 'first', 11L, 'residues', 10)) AS spans
           FROM {spread} LATERAL VIEW explode(sequence(0L, 20L)) t AS i""",
        """SELECT vec_id AS structure_id, CASE WHEN i < 11 THEN 'A' ELSE 'B' END AS chain, i,
                  list_transform(range(0, 21), lambda j: CASE WHEN (i < 11) <> (j < 11)
                    THEN 40 * abs(cast(embedding[3 * i + 1] as double) - cast(embedding[3 * j + 2] as double)) END) AS errors
           FROM (SELECT vec_id, embedding, unnest(range(0, 21)) AS i FROM {embeddings}) a""",
    ),
    "v_chain_scores": (
        """SELECT vec_id AS structure_id, substr('ABCD', cast(a as int) + 1, 1) AS chain_a, substr('ABCD', cast(b as int) + 1, 1) AS chain_b,
                  CASE WHEN (vec_id + a + b) % 9 = 0 THEN NULL
                       ELSE least(cast(1 as double), 4 * abs(cast(embedding[8 * a + b] as double))) END AS value
           FROM {spread} LATERAL VIEW explode(sequence(0L, 3L)) t AS a
           LATERAL VIEW explode(sequence(0L, 3L)) u AS b WHERE a <> b""",
        """SELECT vec_id AS structure_id, substr('ABCD', cast(a as int) + 1, 1) AS chain_a, substr('ABCD', cast(b as int) + 1, 1) AS chain_b,
                  CASE WHEN (vec_id + a + b) % 9 = 0 THEN NULL
                       ELSE least(cast(1 as double), 4 * abs(cast(embedding[8 * a + b + 1] as double))) END AS value
           FROM (SELECT *, unnest(range(0, 4)) AS b FROM
                 (SELECT vec_id, embedding, unnest(range(0, 4)) AS a FROM {embeddings}) x) y WHERE a <> b""",
    ),
    "v_logits": (
        """SELECT vec_id AS candidate_id, i, j,
                  transform(sequence(0L, 15L), b -> 10 * cast(embedding[cast((i + j + b) % 64 as int)] as double)) AS logits
           FROM {spread} LATERAL VIEW explode(sequence(0L, 20L)) t AS i
           LATERAL VIEW explode(sequence(0L, 20L)) u AS j""",
        """SELECT vec_id AS candidate_id, i, j,
                  list_transform(range(0, 16), lambda b: 10 * cast(embedding[(i + j + b) % 64 + 1] as double)) AS logits
           FROM (SELECT *, unnest(range(0, 21)) AS j FROM
                 (SELECT vec_id, embedding, unnest(range(0, 21)) AS i FROM {embeddings}) a) b""",
    ),
}

VIEW_NAMES = [*SHARED, *PAIRED]


def _dialect(text: str, spark: bool) -> str:
    body = r"(timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, \1))" if spark else r"make_timestamp((1704067200 + \1) * 1000000)"
    return re.sub(r"@TS\[(.*?)\]@", body, text)


def _refs(text: str) -> list[str]:
    return re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text)


class Campaign:
    """Tables and views of one data folder, each resolved lazily to a DataFrame."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self._load(name)
        return self._cache[name]

    def _load(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name == "spread":
            # One row becomes hundreds: spread the small rows first, so few input files do
            # not mean few tasks.
            n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            return self.embeddings.repartition(n, "vec_id")
        view = name if name.startswith("v_") else f"v_{name}"
        text = SHARED[view] if view in SHARED else PAIRED[view][0]
        return self.spark.sql(_dialect(text, True), **{r: getattr(self, r) for r in _refs(text)})


def oracle(body: str) -> str:
    """SQL for the checking engine: ``body`` preceded by the views it names."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEW_NAMES:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(SHARED[name] if name in SHARED else PAIRED[name][1])
                needed.append(name)

    visit(body)
    ctes = []
    for name in needed:
        text = SHARED[name] if name in SHARED else PAIRED[name][1]
        for ref in set(_refs(text)):
            text = text.replace("{" + ref + "}", ref)
        ctes.append(f"{name} AS ({_dialect(text, False).replace('{{', '{').replace('}}', '}')})")
    body = body.strip()
    head = re.match(r"with\s+(recursive\s+)?", body, re.I)
    if head:
        if not ctes:
            return body
        return f"WITH {head.group(1) or ''}{', '.join(ctes)}, {body[head.end():]}"
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
