"""Registered queries of the operators, each over its whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindscope.llm import (
    decontaminate, merkle, ngram_join, oracles, packing, quality, repeats, secrets, suffix_tree, token_files, topk_search, toxicity, warc, whitening,
)
from bindscope.llm.shared import table
from bindscope.session import scratch


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, folder, "documents"), n=3, threshold=90)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.dedup_substrings(table(spark, folder, "documents"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("items")


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path, min_bytes=0)
    return warc.read_archives(spark, path, payload=False).drop("url", "file", "offset")


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "token-files")
    token_files.write_ids(table(spark, folder, "documents"), path, tokenizer_path("word_bpe_49k.json"), end=2)
    return token_files.read_ids(spark, path, with_ids=False)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), with_ids=False)


def op9_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"))


def op10_suffix_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree.suffix_tree_scores(table(spark, folder, "documents"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    proofs = merkle.manifest(table(spark, folder, "documents"))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", "proof").cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified"
    )


def op13_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_toxicity": op2_toxicity,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_warc": op6_warc,
    "op7_token_files": op7_token_files,
    "op8_packing": op8_packing,
    "op9_secret_scans": op9_secret_scans,
    "op10_suffix_tree_scores": op10_suffix_tree_scores,
    "op11_whitening": op11_whitening,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_exact_top_k": op13_exact_top_k,
}
ORACLES: dict[str, str] = {"op12_merkle_manifest": oracles.MERKLE, "op13_exact_top_k": oracles.TOP_K}
