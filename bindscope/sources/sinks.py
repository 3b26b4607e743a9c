"""Report formatting and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindscope.functions import scalars as S


def format_report(df: DataFrame) -> DataFrame:
    """Every column as report text: NULL is empty, booleans are true/false, reals have at
    most three decimals."""
    return df.select(*[S.render_value(f"`{f.name}`", f.dataType).alias(f.name) for f in df.schema.fields])


def write_report_csv(df: DataFrame, path: str, metadata: DataFrame | None = None) -> None:
    """Report CSV; the optional (position, key, value) pairs become a leading ``#`` line in
    a file of their own, so the data is still written by many tasks."""
    format_report(df).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
    if metadata is not None:
        head = F.concat(F.col("line"), F.lit("\n" + ",".join(df.columns)))
        metadata_line(metadata).select(head.alias("value")).write.mode("append").text(path)


# Keys of the metadata line, in order.
METADATA_KEYS = ("target_name", "binder_scaffold", "frameworks", "num_designs", "critic")


def report_metadata(rows: DataFrame) -> DataFrame:
    """(key, value) pairs describing a report, blanks left out; one aggregation.

    Framework and critic names are few by contract: they name bundled panels and models.
    """
    names = lambda c: F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit("")))), ";")
    agg = rows.agg(
        F.min("target_name").alias("target_name"), F.min("binder_scaffold").alias("binder_scaffold"), names("framework").alias("frameworks"),
        F.count_distinct("candidate_id").cast("string").alias("num_designs"), names("critic_name").alias("critic"),
    )
    items = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(k).alias("key"), F.col(k).alias("value")) for i, k in enumerate(METADATA_KEYS)])
    return agg.select(F.inline(items)).filter("value is not null and value <> ''")


# Keys of the configured metadata, in order.
CONFIGURED_KEYS = (
    "target_name", "binder_scaffold", "frameworks", "num_designs", "steps", "critic", "binder_target_contact_mode", "mosaic_cdr_contact_weight",
    "mosaic_framework_contact_penalty_weight", "mosaic_framework_contact_penalty_scope", "target_geometry_drift_enabled", "target_geometry_drift_weight",
    "target_geometry_drift_tolerance_angstrom", "target_geometry_drift_stiffness_angstrom", "target_geometry_drift_regions",
)


def campaign_metadata(configs: DataFrame, rows: DataFrame, by: str, text: str = "resolved_config_json") -> DataFrame:
    """(by, position, key, value) per campaign: what its configuration says, and where it is
    silent about target, scaffold, frameworks or critics, what its report ``rows`` show. Blanks
    are left out; a configuration that is no JSON object says nothing."""
    names = lambda c: F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit("")))), ";")
    seen = rows.groupBy(by).agg(
        F.min("target_name").alias("target"), F.min("binder_scaffold").alias("scaffold"), names("framework").alias("fw"), names("critic_name").alias("critics")
    )
    doc = configs.select(by, F.try_parse_json(text).alias("v")).join(seen, by, "left")
    get = lambda path, kind="string": F.try_variant_get("v", f"$.{path}", kind)
    filled = lambda c: F.nullif(c, F.lit(""))
    name = lambda v: F.coalesce(F.try_variant_get(v, "$.name", "string"), F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    listed = F.array_join(F.array_compact(F.transform(get("binder.frameworks", "array<variant>"), name)), ";")
    frameworks = F.when(get("binder.framework", "variant").isNotNull(), name(get("binder.framework", "variant"))).otherwise(listed)
    critics = F.array_join(get("campaign.critics", "array<string>"), ";")
    mosaic = get("loss.binder_target_contact_mode") == "mosaic_cdr"
    drift = "loss.target_geometry_drift"
    on = get(f"{drift}.enabled", "boolean")
    regions = get(f"{drift}.regions", "map<string,variant>")
    selectors = lambda v: F.coalesce(F.array_join(F.try_variant_get(v, "$", "array<string>"), "+"), F.try_variant_get(v, "$", "string"))
    chains = F.transform(F.array_sort(F.map_keys(regions)), lambda k: F.concat(k, F.lit(":"), selectors(F.try_element_at(regions, k))))
    where = F.coalesce(filled(F.array_join(chains, ";")), filled(get(f"{drift}.regions")), F.lit("all"))
    values = {
        "target_name": F.coalesce(filled(get("target.name")), F.col("target")), "binder_scaffold": F.coalesce(filled(get("binder.scaffold")), F.col("scaffold")),
        "frameworks": F.coalesce(filled(frameworks), F.col("fw")), "num_designs": get("campaign.num_designs"), "steps": get("campaign.steps"),
        "critic": F.coalesce(filled(critics), F.col("critics")), "binder_target_contact_mode": F.when(mosaic, "mosaic_cdr"),
        **{k: F.when(mosaic, get(f"loss.{k}")) for k in CONFIGURED_KEYS[7:10]}, "target_geometry_drift_enabled": get(f"{drift}.enabled"),
        **{f"target_geometry_drift_{k}": F.when(on, get(f"{drift}.{k}")) for k in ("weight", "tolerance_angstrom", "stiffness_angstrom")},
        "target_geometry_drift_regions": F.when(on, where),
    }
    items = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(k).alias("key"), values[k].alias("value")) for i, k in enumerate(CONFIGURED_KEYS)])
    return doc.select(by, F.inline(items)).filter("value is not null and value <> ''")


def metadata_line(pairs: DataFrame) -> DataFrame:
    text = F.concat_ws("=", "key", "value")
    cells = F.transform(F.array_sort(F.collect_list(F.struct("position", text.alias("t")))), lambda x: x["t"])
    return pairs.agg(F.concat_ws(",", F.lit("# campaign"), F.array_join(cells, ",")).alias("line"))


def summary_json(df: DataFrame) -> DataFrame:
    """JSON text with sorted keys."""
    return df.select(F.to_json(F.struct(*sorted(df.columns))).alias("value"))


def write_summary(df: DataFrame, path: str) -> None:
    summary_json(df).write.mode("overwrite").text(path)


def with_model_slug(df: DataFrame, model: str = "model_name", fallback: str = "validator") -> DataFrame:
    return df.withColumn("validator_slug", S.slug(model, fallback))


def write_by_model(df: DataFrame, path: str, model: str = "model_name", fallback: str = "validator") -> None:
    """One folder per validator model. Rows are spread by a salt before the write, so one
    large model does not end in one task."""
    out = with_model_slug(df, model, fallback)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = out.repartition(n, "validator_slug", F.pmod(F.xxhash64(*df.columns), F.lit(n)))
    salted.write.mode("overwrite").partitionBy("validator_slug").parquet(path)


def write_conditioning(pairs: DataFrame, path: str) -> None:
    """Pair table partitioned by chain pair."""
    pairs.write.mode("overwrite").partitionBy("chain_i", "chain_j").parquet(path)


def write_fasta(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)

