"""Shortlists, task order, sample order and the final ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindscope.functions import scalars as S
from bindscope.operators import gating as G
from bindscope.operators import ranking as R


def selection_keys() -> list[Column]:
    """ipTM, then the proxy that fits the binder type, then the plain proxy, then names."""
    antibody = F.col("binder_type").isin("scfv", "vhh")
    proxy = F.when(antibody, F.col("cdr_distogram_iptm_proxy")).otherwise(F.col("distogram_iptm_proxy"))
    return [
        R.high_first("iptm"), R.high_first(proxy), R.high_first("distogram_iptm_proxy"),
        R.text_first("candidate_id"), R.text_first("critic_name"),
    ]


def candidate_pool(rows: DataFrame, min_iptm: float | None, gate: str = "auto", configured: bool = False) -> DataFrame:
    """Score filter, hotspot gate, best row per exact sequence."""
    kept = G.hotspot_gate(G.filter_min(rows, "iptm", min_iptm), gate, configured, flag="hotspot_pass")
    return R.dedup_best(kept, "designed_sequence", selection_keys())


def select_designs(rows: DataFrame, max_n: int = 100, min_iptm: float | None = None, gate: str = "auto", configured: bool = False) -> DataFrame:
    return R.top_n(candidate_pool(rows, min_iptm, gate, configured), selection_keys(), max_n, "rank")


def plan_selection(
    rows: DataFrame, model: str, config_hash: str, min_iptm: float | None = None, gate: str = "auto", top_k: int | None = None
) -> DataFrame:
    """Validation tasks in selection order; without ``top_k`` the whole pool is ranked."""
    pool = candidate_pool(rows, min_iptm, gate)
    if top_k is not None:
        ranked = R.top_n(pool, selection_keys(), top_k, "selection_rank")
    else:
        ranked = R.add_rank(pool, selection_keys(), "selection_rank", columns=["candidate_id"])
    return ranked.select(
        S.task_id("candidate_id", F.lit(model), F.lit(config_hash)).alias("validation_id"),
        "candidate_id", F.lit(model).alias("model_name"), F.lit(config_hash).alias("validation_config_hash"),
        "selection_rank",
    )


def task_keys() -> list[Column]:
    return [
        R.status_order("validator_status"), R.high_first("validator_iptm"), R.high_first("validator_ipsae"),
        R.high_first("validator_ranking_score"), R.int_first("selection_rank"), R.text_first("validation_id"),
    ]


def validation_rank(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rank inside each model; a model may hold any share of the rows."""
    return R.add_rank(rows, task_keys(), "validation_rank", by=["model_name"], columns=columns)


def sample_keys() -> list[Column]:
    return [
        R.true_first(F.col("structure_status").eqNullSafe("passing")), R.high_first("validator_iptm"),
        R.high_first("validator_ipsae"), R.high_first("validator_ranking_score"),
        F.coalesce("seed", F.lit(0)), F.coalesce("sample_rank", F.lit(0)), R.text_first("structure_id"),
    ]


def order_samples(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return R.add_rank(rows, sample_keys(), "sample_order", by=["model_name"], columns=columns)


def best_sample(samples: DataFrame) -> DataFrame:
    """Passing first, then ipTM, ipSAE and ranking score (missing = -1), then lowest sample."""
    down = lambda c: -F.coalesce(F.col(c), F.lit(-1.0))
    keys = [
        R.true_first(F.col("status").eqNullSafe("passing")), down("scoped_iptm"), down("scoped_ipsae"),
        down("ranking_score"), F.col("sample_rank").asc(), F.col("seed").asc(), F.col("structure_id").asc(),
    ]
    return R.best_per_group(samples, ["validation_id"], keys)


def validator_rank(scored: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rank over completed rows that have an evaluator score; others keep NULL."""
    rankable = (F.col("validator_status") == "completed") & F.col("evaluator_score").isNotNull()
    keys = [
        R.high_first("evaluator_score"), R.high_first("validator_iptm"), R.high_first("validator_ipsae"),
        R.text_first("candidate_id"), R.text_first("validation_id"),
    ]
    # One pass: unrankable rows form their own group and lose the number afterwards.
    marked = scored.withColumn("__in", F.coalesce(rankable, F.lit(False)))
    names = scored.columns if columns is None else columns
    ranked = R.add_rank(marked, keys, "validator_rank", by=["__in"], columns=[*names, "__in"])
    return ranked.withColumn("validator_rank", F.when(F.col("__in"), F.col("validator_rank"))).drop("__in")


def final_keys() -> list[Column]:
    return [
        R.status_order("validator_status"),
        R.true_first(F.col("ranking_eligible")),
        R.true_first(S.opt_bool("validator_passed")),
        R.high_first("final_score"),
        R.low_first("rmsd"),
        R.high_first("evaluator_score"),
        R.high_first("critic_iptm"),
        R.int_first("selection_rank"),
        R.text_first("candidate_id"),
        R.text_first("validation_id"),
    ]


def final_rank(scored: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number eligible rows in final order; diagnostics keep every row. ``columns``, if given,
    must hold ranking_eligible."""
    ranked = R.add_rank(scored, final_keys(), "final_rank", by=["ranking_eligible"], columns=columns)
    return ranked.withColumn("final_rank", F.when(F.col("ranking_eligible"), F.col("final_rank")))


def score_correlation(df: DataFrame, x: str, y: str, tie: str) -> DataFrame:
    """n, Pearson and Spearman over rows with both scores; NULL when undefined.

    Spearman uses ordinal ranks, ties broken by ``tie``.
    """
    pts = df.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(tie).alias("tie")).filter(
        "x is not null and y is not null"
    )
    ranked = R.add_rank(pts, [F.col("x"), F.col("tie")], "rx")
    ranked = R.add_rank(ranked, [F.col("y"), F.col("tie")], "ry", columns=["x", "y", "rx"], sample=pts)
    agg = ranked.agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop("x", "y").alias("cxy"), F.covar_pop("rx", "ry").alias("crr"),
        *[F.stddev_pop(c).alias(f"s_{c}") for c in ("x", "y", "rx", "ry")],
    )
    ok = (F.col("n") >= 2) & (F.col("s_x") > 0) & (F.col("s_y") > 0)
    ratio = lambda c, a, b: F.when(ok, F.try_divide(F.col(c), F.col(a) * F.col(b)))
    return agg.select("n", ratio("cxy", "s_x", "s_y").alias("pearson"), ratio("crr", "s_rx", "s_ry").alias("spearman"))


def scatter_points(df: DataFrame, x: str, y: str, color: str, cap: float = 20.0) -> DataFrame:
    rejected = ~F.coalesce(S.opt_bool("validator_passed"), F.lit(False))
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        "validation_id", F.col(x).alias("x"), F.col(y).alias("y"),
        F.greatest(F.lit(0.0), F.least(F.col(color), F.lit(cap))).alias("color"), rejected.alias("rejected"),
    )


def top_summaries(df: DataFrame, keys: list[Column], fields: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows as JSON text without NULL fields."""
    head = R.top_n(df, keys, n, "position")
    return head.select("position", F.to_json(F.struct(*fields)).alias("summary"))


def paired_topk_manifest(ranked: DataFrame, inventory: DataFrame, k: int) -> DataFrame:
    """The first ``k`` eligible designs whose two structure files both exist."""
    names = ["final_rank", "candidate_id", "model_name", "source_structure_path", "validated_structure_path"]
    eligible = ranked.filter(F.col("ranking_eligible")).select(*names)
    # Both files of a design are looked for by one join, so the inventory is sorted once.
    asked = eligible.withColumn("path", F.explode(F.array("source_structure_path", "validated_structure_path")))
    found = asked.join(inventory.select("path"), "path", "left_semi")
    both = found.groupBy(*names).agg(F.count(F.lit(1)).alias("files")).filter("files = 2")
    head = both.orderBy("final_rank").limit(k)
    stem = F.concat(F.lit("rank"), S.zero_pad("final_rank", 4), F.lit("_"), S.safe_token("candidate_id"))
    model = S.slug("model_name", "validator")
    suffix = F.coalesce(F.nullif(F.regexp_extract("validated_structure_path", r"(\.[^./]+)$", 1), F.lit("")), F.lit(".cif"))
    return head.select(
        "final_rank", "candidate_id", "source_structure_path", "validated_structure_path",
        F.concat(F.lit("critic/"), stem, F.lit("_critic.pdb")).alias("critic_copy"),
        F.concat(model, F.lit("/"), stem, F.lit("_"), model, suffix).alias("validator_copy"),
    )


def selected_manifest(ranked: DataFrame, n: int | None) -> DataFrame:
    head = ranked if n is None else ranked.orderBy("rank").limit(n)
    return head.select(
        "rank", "candidate_id", "designed_sequence", "critic_name", "iptm", "structure_path",
        F.element_at(F.split("structure_path", "/"), -1).alias("file_name"),
    )


def analysis_report(scored: DataFrame, copied: DataFrame | Column, top_k: int, by: Sequence[str] = (), error: str = "pose_error") -> DataFrame:
    """Counts of an analysis, in one row (or one per ``by``): as ``analysis_summary``, with the
    designs whose files were ``copied`` (their validation_id, or a flag of the rows), rows per
    validator model and per pose error, and how many rows have a pose. One pass over the rows,
    tagged by model and error."""
    if isinstance(copied, DataFrame):
        held = copied.select("validation_id").distinct().withColumn("__copied", F.lit(True))
        rows = scored.join(held, "validation_id", "left")
    else:
        rows = scored.withColumn("__copied", copied)
    passed = F.coalesce(S.opt_bool("validator_passed"), F.lit(False))
    n = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))
    parts = rows.groupBy(*by, F.coalesce(F.nullif("model_name", F.lit("")), F.lit("unknown")).alias("__m"), F.nullif(F.col(error), F.lit("")).alias("__e")).agg(
        F.count(F.lit(1)).alias("rows"), n(F.col("ranking_eligible")).alias("eligible"), n(passed).alias("passed"),
        n(F.col("__copied") & F.col("ranking_eligible")).alias("copied"), F.count("rmsd").alias("posed"),
    )
    # The few rows of ``parts`` are read once: per model, per error and over both.
    kinds = [F.col(c) for c in by]
    sums = [F.sum(c).alias(c) for c in ("rows", "eligible", "passed", "copied", "posed")]
    sets = parts.groupingSets([[*kinds, F.col("__m")], [*kinds, F.col("__e")], kinds], *kinds, F.col("__m"), F.col("__e")).agg(
        (F.grouping("__m") == 0).alias("__by_model"), (F.grouping("__e") == 0).alias("__by_error"), *sums
    )
    listed = lambda cond, key: F.array_sort(F.collect_list(F.when(cond, F.struct(key, F.col("rows").alias("n")))))
    whole = ~F.col("__by_model") & ~F.col("__by_error")
    of = lambda c: F.max(F.when(whole, c))
    out = sets.groupBy(*by).agg(
        of(F.col("eligible")).alias("ranked_designs"), of(F.col("rows")).alias("diagnostic_rows"), of(F.col("passed")).alias("validator_pass_count"),
        of(F.col("rows") - F.col("passed")).alias("validator_reject_or_failed_count"), of(F.col("rows") - F.col("eligible")).alias("ranking_ineligible_count"),
        of(F.col("copied")).alias("copied_designs"), of(F.col("posed")).alias("rows_with_binder_ca_rmsd"),
        of(F.col("rows") - F.col("posed")).alias("rows_missing_binder_ca_rmsd"),
        listed(F.col("__by_model"), "__m").alias("__models"), listed(F.col("__by_error") & F.col("__e").isNotNull(), "__e").alias("__errors"),
    )
    mapped = lambda c: F.when((F.size(c) > 0) | F.lit(not by), F.map_from_entries(c))
    return out.withColumn("top_k", F.lit(top_k).cast("bigint")).withColumn("validator_models", mapped("__models")).withColumn(
        "pose_errors", mapped("__errors")
    ).drop("__models", "__errors")


def analysis_summary(scored: DataFrame, copied: int) -> DataFrame:
    eligible = F.col("ranking_eligible")
    passed = F.coalesce(S.opt_bool("validator_passed"), F.lit(False))
    return scored.agg(
        F.count_if(eligible).alias("ranked_designs"),
        F.count(F.lit(1)).alias("diagnostic_rows"),
        F.count_if(passed).alias("validator_pass_count"),
        F.count_if(~passed).alias("validator_reject_or_failed_count"),
        F.count_if(~eligible).alias("ranking_ineligible_count"),
        F.lit(copied).cast("bigint").alias("top_k"),
    )

