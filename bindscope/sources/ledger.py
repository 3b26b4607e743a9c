"""The campaign ledger with its fixed schema."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ledger tables and their columns.
COLUMNS = {
    "campaign": """
        id BIGINT, schema_version BIGINT, config_hash STRING, resolved_config_json STRING, software_versions_json STRING,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "shards": """
        shard_id STRING, campaign_id BIGINT, seed BIGINT, batch_index BIGINT, target_key STRING, binder_key STRING,
        critic_set_json STRING, status STRING, claim_worker_id STRING, claim_hostname STRING, claim_pid BIGINT, claim_gpu_id STRING,
        claimed_at TIMESTAMP_NTZ, heartbeat_at TIMESTAMP_NTZ, attempt_count BIGINT, max_attempts BIGINT, created_at TIMESTAMP_NTZ,
        started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, error_message STRING""",
    "candidates": """
        candidate_id STRING, shard_id STRING, candidate_index BIGINT, designed_sequence STRING, binder_chain_id STRING,
        status STRING, sequence_path STRING, design_metrics_json STRING, created_at TIMESTAMP_NTZ, started_at TIMESTAMP_NTZ,
        completed_at TIMESTAMP_NTZ, error_message STRING""",
    "critic_metrics": """
        candidate_id STRING, critic_name STRING, status STRING, structure_path STRING, metrics_json STRING, iptm DOUBLE, ptm DOUBLE,
        plddt DOUBLE, distogram_iptm_proxy DOUBLE, hotspot_satisfaction DOUBLE, runtime_seconds DOUBLE, attempt_count BIGINT,
        created_at TIMESTAMP_NTZ, started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, error_message STRING""",
    "validation_tasks": """
        validation_id STRING, candidate_id STRING, model_name STRING, validation_config_hash STRING, selection_rank BIGINT,
        status STRING, claim_worker_id STRING, claim_hostname STRING, claim_pid BIGINT, claim_gpu_id STRING,
        claimed_at TIMESTAMP_NTZ, heartbeat_at TIMESTAMP_NTZ, attempt_count BIGINT, max_attempts BIGINT, created_at TIMESTAMP_NTZ,
        started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, output_structure_path STRING, metrics_json STRING, iptm DOUBLE,
        ipsae DOUBLE, ptm DOUBLE, ranking_score DOUBLE, hotspot_satisfaction DOUBLE, runtime_seconds DOUBLE, error_message STRING""",
    "validation_structures": """
        validation_id STRING, structure_id STRING, candidate_id STRING, model_name STRING, seed BIGINT, sample_rank BIGINT,
        status STRING, structure_path STRING, metrics_json STRING, scoped_iptm DOUBLE, scoped_ipsae DOUBLE, ptm DOUBLE,
        ranking_score DOUBLE, hotspot_satisfaction DOUBLE, created_at TIMESTAMP_NTZ""",
    "validation_msa_jobs": """
        msa_job_id STRING, scope STRING, cache_key STRING, msa_context_hash STRING, status STRING, claim_worker_id STRING,
        claim_hostname STRING, claim_pid BIGINT, claimed_at TIMESTAMP_NTZ, heartbeat_at TIMESTAMP_NTZ, attempt_count BIGINT,
        max_attempts BIGINT, next_eligible_at TIMESTAMP_NTZ, representative_sequence STRING, member_sequences_json STRING,
        cache_paths_json STRING, metadata_json STRING, created_at TIMESTAMP_NTZ, started_at TIMESTAMP_NTZ,
        completed_at TIMESTAMP_NTZ, error_message STRING""",
    "validation_msa_job_candidates": """
        candidate_id STRING, msa_job_id STRING, validation_config_hash STRING, reason STRING, created_at TIMESTAMP_NTZ""",
    "attempts": """
        attempt_id BIGINT, shard_id STRING, candidate_id STRING, validation_id STRING, critic_name STRING, stage STRING,
        status STRING, worker_id STRING, hostname STRING, pid BIGINT, gpu_id STRING, started_at TIMESTAMP_NTZ,
        ended_at TIMESTAMP_NTZ, exit_code BIGINT, log_path STRING, traceback_path STRING, error_message STRING""",
}


def column_names(table: str) -> list[str]:
    return [column.split()[0] for column in COLUMNS[table].split(",")]


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(COLUMNS[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Ledger columns in order and type; absent columns are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema(table).fields
        ]
    )


def read_ledger(spark: SparkSession, folder: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """Parquet tables under ``folder/<table>`` with declared schemas: no inference pass."""
    return {t: spark.read.schema(schema(t)).parquet(f"{folder}/{t}") for t in tables or COLUMNS}


def read_ledger_jdbc(spark: SparkSession, url: str, table: str, split_column: str, bounds: tuple[int, int], parts: int, **options: str) -> DataFrame:
    """A ledger table kept in a database, read in ``parts`` range partitions."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=split_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts), **options
    )
    return conform(reader.load(), table)


def write_ledger(tables: dict[str, DataFrame], folder: str) -> None:
    """Each table under ``folder/<table>``. The tables are written side by side: a table's last
    tasks leave cores to the others."""
    def write(name: str) -> None:
        conform(tables[name], name).write.mode("overwrite").parquet(f"{folder}/{name}")

    if not tables:
        return
    spark = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(len(tables)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), tables))
