"""Small tabular inputs: framework panels, alignment maps, ranked CSV, file inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindscope.functions import scalars as S
from bindscope.functions.scalars import nonblank, normalize_sequence
from bindscope.operators.ledger import alias_conflicts

FRAMEWORK_SCHEMA = (
    "id string, canonical_name string, aliases array<string>, modality string, template string, "
    "cdr_lengths map<string,struct<min:int,max:int>>"
)


def framework_dim(spark: SparkSession, path: str) -> DataFrame:
    """Framework records (JSON lines), one row per framework."""
    return spark.read.schema(FRAMEWORK_SCHEMA).json(path)


def alias_index(dim: DataFrame) -> DataFrame:
    """(alias, canonical) with the canonical name as an alias of itself."""
    names = F.array_union(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = dim.select(F.explode(names).alias("alias"), F.col("canonical_name").alias("canonical"))
    return rows.select(F.lower(F.trim("alias")).alias("alias"), "canonical").distinct()


def require_unique_aliases(index: DataFrame) -> DataFrame:
    bad = alias_conflicts(index).select(F.col("alias").alias("__bad"))
    joined = index.join(bad, index["alias"] == bad["__bad"], "left")
    text = F.concat(F.lit("duplicate framework alias "), "alias")
    return joined.select(F.when(F.col("__bad").isNull(), F.col("alias")).otherwise(F.raise_error(text).cast("string")).alias("alias"), "canonical")


# Accepted column names of an alignment map, in order of precedence.
MSA_MAP_NAMES = {
    "target_name": ("target_name", "name", "target"),
    "label": ("chain", "label"),
    "sequence": ("target_sequence", "sequence"),
    "msa_dir": ("msa_dir", "msa_path"),
    "pairing_path": ("pairing_path",),
    "non_pairing_path": ("non_pairing_path", "unpaired_msa_path"),
}


def msa_map(df: DataFrame) -> DataFrame:
    """Rename by trimmed lower-case header; the first non-blank spelling wins."""
    lowered = df.select(*[F.trim(F.col(f"`{c}`")).alias(c.strip().lower().lstrip("﻿")) for c in df.columns])
    out = []
    for name, spellings in MSA_MAP_NAMES.items():
        held = [F.col(s) for s in spellings if s in lowered.columns]
        value = nonblank(*held) if held else F.lit(None).cast("string")
        out.append((normalize_sequence(value) if name == "sequence" else value).alias(name))
    return lowered.select(*out)


def read_msa_map(spark: SparkSession, path: str) -> DataFrame:
    return msa_map(spark.read.csv(path, header=True))


def read_ranked_csv(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """CSV with ``#`` metadata lines; missing required columns are an error."""
    df = spark.read.option("comment", "#").csv(path, header=True)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"ranked CSV lacks columns: {', '.join(missing)}")
    return df


def is_artifact(path: Column | str) -> Column:
    """Not a dot-file and not a temporary file."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return ~name.startswith(".") & ~name.endswith(".tmp") & (name != "")


def read_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Relative path and size of every artifact; file contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("size"))
    base = root.rstrip("/").split("://")[-1]
    rel = F.substring(F.col("path"), F.instr("path", F.lit(base)) + F.lit(len(base) + 1), F.length("path"))
    return files.select(rel.alias("path"), "size").filter(is_artifact("path"))


def pair_outputs(inventory: DataFrame) -> DataFrame:
    """Summary files with their structure and full-data siblings by folder, seed and
    sample; a summary without a structure is dropped."""
    folder = F.left("path", F.length("path") - F.length("name") - 1)
    seed = F.regexp_extract("path", r"/seed_(\d+)/", 1).try_cast("bigint")
    patterns = {
        "summary": r"^(.*)_summary_confidence_sample_(\d+)\.json$", "full": r"^(.*)_full_data_sample_(\d+)\.json$", "cif": r"^(.*)_sample_(\d+)\.cif$",
    }
    # A name is of one kind at most, so one exchange of the files brings all siblings together;
    # each text is cut once.
    named = S.once(inventory.select("path"), "name", F.substring_index("path", "/", -1))
    kind = F.coalesce(*[F.when(F.col("name").rlike(p), F.lit(n)) for n, p in patterns.items()])
    found = S.once(named, "kind", kind).filter("kind is not null")
    of = lambda k: F.coalesce(*[F.when(F.col("kind") == n, F.regexp_extract("name", p, k)) for n, p in patterns.items()])
    cut = S.once(found, "c", F.struct(folder.alias("folder"), seed.alias("seed"), of(1).alias("stem"), of(2).try_cast("bigint").alias("sample_rank")))
    files = cut.select("path", "kind", "c.*")
    held = files.filter("kind is not null and sample_rank is not null").groupBy("folder", "stem", "sample_rank").agg(
        F.collect_list(F.when(F.col("kind") == "summary", F.struct("seed", F.col("path").alias("summary")))).alias("s"),
        *[F.collect_list(F.when(F.col("kind") == n, F.col("path"))).alias(n) for n in ("full", "cif")],
    )
    whole = held.select("stem", "sample_rank", "full", "cif", F.inline("s")).withColumn("cif", F.explode("cif"))
    return whole.withColumn("full", F.explode_outer("full")).select("seed", "sample_rank", "stem", "summary", "full", "cif")
