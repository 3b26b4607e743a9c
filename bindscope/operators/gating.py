"""Row projections, filters, gates and eligibility rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindscope.functions import scalars as S

# Metric keys in order of precedence.
FINAL_LOSS_KEYS = ("final_loss", "loss")
FRAMEWORK_KEYS = ("framework", "framework_name")
CUTOFF_KEYS = (
    "cdr_hotspot_contact_cutoff_angstrom",
    "hotspot_critic_contact_cutoff_angstrom",
    "hotspot_contact_cutoff_angstrom",
)
SATISFACTION_KEYS = ("cdr_hotspot_pass", "cdr_hotspot_satisfaction", "hotspot_satisfaction")
DISTANCE_KEYS = (
    "cdr_hotspot_distance_angstrom",
    "cdr_hotspot_min_heavy_atom_distance_min",
    "hotspot_min_heavy_atom_distance_min",
)
VALIDATION_DISTANCE_KEYS = (
    "validation_hotspot_distance_angstrom",
    "hotspot_distance_angstrom",
    "cdr_hotspot_distance_angstrom",
    "cdr_hotspot_min_heavy_atom_distance_min",
    "hotspot_min_heavy_atom_distance_min",
)
VHH_CDR_KEYS = {
    "hcdr1": ("hcdr1", "cdr1"),
    "hcdr2": ("hcdr2", "cdr2"),
    "hcdr3": ("hcdr3", "cdr3"),
}
PAIRED_CDR_KEYS = {
    "cdrh1": ("hcdr1",), "cdrh2": ("hcdr2",), "cdrh3": ("hcdr3",),
    "cdrl1": ("lcdr1",), "cdrl2": ("lcdr2",), "cdrl3": ("lcdr3",),
}


# ------------------------------------------------------------------ projection
def binder_type(doc: Column | str) -> Column:
    get = lambda key: F.try_element_at(_c(doc), F.lit(key))
    code = lambda key: F.when(get(key) != "", S.binder_code(get(key)))
    return S.nonblank(get("binder_type"), code("binder_scaffold"), code("binder_name"), F.lit("binder"))


def binder_scaffold(doc: Column | str, kind: Column) -> Column:
    value = F.lower(F.trim(F.try_element_at(_c(doc), F.lit("binder_scaffold"))))
    plain = F.regexp_replace(F.lower(F.trim(kind)), "^(mp|minibinder)$", "miniprotein")
    return S.nonblank(value, plain, F.lit("binder"))


def cdr_columns(cdr: Column, kind: Column) -> dict[str, Column]:
    """Three columns for single-domain binders, six for paired ones; blanks are NULL.

    ``cdr`` and ``kind`` should be plain columns: they are read once per output.
    """
    out = {}
    for single, table in ((True, VHH_CDR_KEYS), (False, PAIRED_CDR_KEYS)):
        for name, keys in table.items():
            wanted = (kind == "vhh") if single else (kind != "vhh")
            out[name] = F.when(wanted, S.nonblank(*[F.try_element_at(cdr, F.lit(k)) for k in keys]))
    return out


def metric_rows(joined: DataFrame) -> DataFrame:
    """Report rows from completed (candidate, critic) pairs and their two JSON documents."""
    docs = S.once(joined, "__d", S.decode_metrics("design_metrics_json", "candidate_id"))
    docs = S.once(docs, "__c", S.decode_metrics("metrics_json", F.concat_ws(":", "candidate_id", "critic_name")))
    d, c = F.col("__d"), F.col("__c")
    get = lambda doc, key: F.try_element_at(doc, F.lit(key))
    held = lambda key: F.coalesce(F.map_contains_key(c, key), F.lit(False))
    typed = docs.withColumn("binder_type", binder_type("__d")).withColumn(
        "__cdr", F.from_json(get(d, "cdr_sequences"), S.JSON_MAP)
    )
    kind, cdr = F.col("binder_type"), F.col("__cdr")
    ledger = F.create_map(F.lit("hotspot_satisfaction"), F.col("hotspot_satisfaction").cast("string"))
    satisfaction = S.first_present(c, ledger, SATISFACTION_KEYS)
    proxies = [get(c, "cdr_distogram_iptm_proxy").try_cast("double")]
    if "cdr_distogram_iptm_proxy" in joined.columns:  # the ledger keeps it in the document only
        proxies.append(F.col("cdr_distogram_iptm_proxy"))
    return typed.select(
        "candidate_id",
        get(d, "target_name").alias("target_name"),
        binder_scaffold("__d", kind).alias("binder_scaffold"),
        "binder_type",
        S.first_present(d, None, FRAMEWORK_KEYS).alias("framework"),
        get(d, "framework_source").alias("framework_source"),
        "seed",
        "designed_sequence",
        *[v.alias(k) for k, v in cdr_columns(cdr, kind).items()],
        F.length("designed_sequence").alias("binder_length"),
        S.nonblank("binder_chain_id", get(d, "binder_chain_id")).alias("binder_chain_id"),
        "sequence_path",
        "critic_name",
        "structure_path",
        "iptm",
        get(c, "iptm_scope").alias("iptm_scope"),
        get(c, "complex_iptm").alias("complex_iptm"),
        F.when(held("ptm"), get(c, "ptm").try_cast("double")).otherwise(F.col("ptm")).alias("ptm"),
        F.when(held("plddt_complex"), get(c, "plddt_complex").try_cast("double"))
        .when(held("plddt"), get(c, "plddt").try_cast("double"))
        .otherwise(F.col("plddt"))
        .alias("plddt_complex"),
        get(c, "plddt_binder").alias("plddt_binder"),
        get(c, "plddt_target").alias("plddt_target"),
        F.coalesce(*proxies).alias("cdr_distogram_iptm_proxy"),
        "distogram_iptm_proxy",
        S.hotspot_flag(satisfaction).alias("hotspot_pass"),
        S.first_present(c, None, DISTANCE_KEYS).try_cast("double").alias("hotspot_distance_angstrom"),
        S.first_present(c, None, CUTOFF_KEYS).try_cast("double").alias("hotspot_cutoff"),
        get(c, "target_geometry_drift_distance_rmse").alias("target_geometry_drift_distance_rmse"),
        get(c, "target_geometry_drift_aligned_rmsd").alias("target_geometry_drift_aligned_rmsd"),
        S.first_present(d, c, FINAL_LOSS_KEYS).try_cast("double").alias("final_loss"),
    )


def prune_empty(df: DataFrame, optional: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Drop optional columns that are empty in every row and order the rest.

    One aggregation pass over the optional columns; its single row decides the schema.
    """
    flags = df.agg(
        *[F.coalesce(F.bool_or(F.col(c).isNotNull() & (F.col(c).cast("string") != "")), F.lit(False)).alias(c) for c in optional]
    ).first()
    drop = {c for c in optional if not flags[c]}
    names = [c for c in order if c in df.columns and c not in drop]
    return df.select(*names)


# ------------------------------------------------------------------ score gates
def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filter_min(df: DataFrame, col: str, threshold: float | None) -> DataFrame:
    return df if threshold is None else df.filter(F.col(col) >= threshold)


def has_hotspot_metrics(distance: str = "hotspot_distance_angstrom", cutoff: str = "hotspot_cutoff", flag: str | None = None) -> Column:
    filled = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    out = filled(distance) | filled(cutoff)
    return out | filled(flag) if flag else out


def has_hotspot_contact(distance: str = "hotspot_distance_angstrom", cutoff: str = "hotspot_cutoff") -> Column:
    d, c = F.col(distance).try_cast("double"), F.col(cutoff).try_cast("double")
    return F.coalesce(d <= c, F.lit(False))


def hotspot_gate(df: DataFrame, mode: str = "auto", configured: bool = False, flag: str | None = None) -> DataFrame:
    """``auto`` filters only if hotspots are configured or some row carries hotspot metrics."""
    if mode not in ("auto", "always", "never"):
        raise ValueError("mode must be auto, always or never")
    if mode == "never":
        return df
    contact = has_hotspot_contact()
    if mode == "always" or configured:
        return df.filter(contact)
    # An existence test: each task stops at its first row that carries metrics.
    some = df.filter(F.coalesce(has_hotspot_metrics(flag=flag), F.lit(False))).select(F.lit(True).alias("held")).limit(1)
    needed = F.coalesce(some.scalar(), F.lit(False))
    return df.filter(contact | ~needed)


def hotspot_distance(doc: Column | str) -> Column:
    return S.first_nonempty(*[F.try_element_at(_c(doc), F.lit(k)) for k in VALIDATION_DISTANCE_KEYS])


def validator_gate(df: DataFrame, min_iptm: float | None, min_ipsae: float | None) -> DataFrame:
    """Adds ``gate_passed``, ``fail_reason`` and ``ipsae_pass``; reasons keep their order."""
    iptm, ipsae = F.col("validation_iptm"), F.col("validation_ipsae")
    reasons = [F.when(iptm.isNull(), "missing scoped binder-target chain_pair_iptm")]
    if min_ipsae is not None:
        reasons.append(F.when(ipsae.isNull(), "missing scoped binder-target validation_ipSAE"))
    for name, col, floor in (("validation_iptm", iptm, min_iptm), ("validation_ipSAE", ipsae, min_ipsae)):
        if floor is not None:
            text = F.concat(F.lit(f"{name} "), S.fixed_text(col, 4), F.lit(f" below threshold {floor:.4f}"))
            reasons.append(F.when(col < floor, text))
    df = df.withColumn("__reasons", F.array_compact(F.array(*reasons)))
    listed = F.col("__reasons")
    ipsae_pass = F.lit(None).cast("boolean") if min_ipsae is None else F.coalesce(ipsae >= min_ipsae, F.lit(False))
    return df.select(
        *[c for c in df.columns if c != "__reasons"],
        (F.size(listed) == 0).alias("gate_passed"),
        F.when(F.size(listed) > 0, F.array_join(listed, "; ")).alias("fail_reason"),
        ipsae_pass.alias("ipsae_pass"),
    )


def merge_hotspot_verdict(df: DataFrame) -> DataFrame:
    """A failed hotspot check overrides the gate; its reason is appended."""
    failed = F.coalesce(~F.col("hotspot_pass"), F.lit(False))
    merged = F.concat_ws("; ", F.nullif(F.col("fail_reason"), F.lit("")), F.nullif(F.col("hotspot_fail_reason"), F.lit("")))
    return df.withColumn("fail_reason", F.when(failed, merged).otherwise(F.col("fail_reason"))).withColumn(
        "gate_passed", F.when(failed, False).otherwise(F.col("gate_passed"))
    )


def validation_passed(flag: Column | str, path: Column | str) -> Column:
    inside = F.instr(F.concat(F.lit("/"), F.coalesce(_c(path), F.lit(""))), "/passing/") > 0
    return F.coalesce(S.opt_bool(flag), inside)


# --------------------------------------------------------------- final ranking
@dataclass(frozen=True)
class RankingConfig:
    max_binder_rmsd: float | None = 2.5
    rmsd_weight: float = 0.0
    default_scale: float = 2.5

    def __post_init__(self) -> None:
        if self.max_binder_rmsd is not None and not 0 < self.max_binder_rmsd < float("inf"):
            raise ValueError("max_binder_rmsd must be a positive finite number")
        if not 0 <= self.rmsd_weight < 1:
            raise ValueError("rmsd_weight must be at least 0 and less than 1")


def unit_interval(c: Column | str) -> Column:
    x = _c(c).try_cast("double")
    return F.when(x.between(0.0, 1.0) & ~F.isnan(x), x)


def _rmsd(c: str = "rmsd") -> Column:
    x = F.col(c).try_cast("double")
    return F.when((x >= 0) & ~F.isnan(x) & (x < float("inf")), x)


def ranking_eligibility(df: DataFrame, cfg: RankingConfig) -> DataFrame:
    """Adds ``ranking_eligible``, ``ranking_exclusion_reason`` and ``rmsd_pass``."""
    rmsd, gate = _rmsd(), cfg.max_binder_rmsd
    ipsae_given = F.col("validator_ipsae").isNotNull() & (F.col("validator_ipsae").cast("string") != "")
    reasons = [
        F.when(~F.col("validator_status").eqNullSafe("completed"), "validator status is not completed"),
        F.when(~validation_passed("validator_passed", "validated_structure_path"), "validator did not pass"),
        F.when(unit_interval("critic_iptm").isNull(), "missing or invalid critic ipTM"),
        F.when(unit_interval("validator_iptm").isNull(), "missing or invalid validator ipTM"),
        F.when(ipsae_given & unit_interval("validator_ipsae").isNull(), "invalid validator ipSAE"),
    ]
    if gate is not None or cfg.rmsd_weight > 0:
        reasons.append(F.when(rmsd.isNull(), "missing binder CA RMSD after target alignment"))
    rmsd_pass = F.when(rmsd.isNotNull(), F.lit(True) if gate is None else rmsd <= gate)
    if gate is not None:
        text = F.concat(F.lit("binder CA RMSD "), S.fixed_text(rmsd, 3), F.lit(f" exceeds {gate:.3f} angstrom"))
        reasons.append(F.when(rmsd > gate, text))
    df = df.withColumn("__reasons", F.array_compact(F.array(*reasons)))
    listed = F.col("__reasons")
    return df.select(
        *[c for c in df.columns if c != "__reasons"],
        (F.size(listed) == 0).alias("ranking_eligible"),
        F.when(F.size(listed) > 0, F.array_join(listed, "; ")).alias("ranking_exclusion_reason"),
        rmsd_pass.alias("rmsd_pass"),
    )


def consensus_score(df: DataFrame, cfg: RankingConfig) -> DataFrame:
    """Evaluator, confidence, agreement and final score of a critic/validator pair."""
    given = F.col("validator_ipsae").isNotNull() & (F.col("validator_ipsae").cast("string") != "")
    critic, viptm, vipsae = unit_interval("critic_iptm"), unit_interval("validator_iptm"), unit_interval("validator_ipsae")
    evaluator = F.when(~given, viptm).otherwise(F.sqrt(viptm * vipsae))
    scale = cfg.max_binder_rmsd or cfg.default_scale
    agreement = F.exp(F.lit(-0.5) * F.pow(_rmsd() / scale, F.lit(2.0)))
    out = df.withColumn("evaluator_score", evaluator).withColumn(
        "metric_basis",
        F.when(viptm.isNotNull() & vipsae.isNotNull(), "critic_iptm+validator_iptm+validator_ipsae").otherwise(
            "critic_iptm+validator_iptm"
        ),
    )
    out = out.withColumn("confidence_score", F.sqrt(critic * F.col("evaluator_score"))).withColumn(
        "agreement_score", agreement
    )
    w = cfg.rmsd_weight
    if w == 0:
        return out.withColumn("final_score", F.col("confidence_score"))
    return out.withColumn(
        "final_score",
        F.pow(F.col("confidence_score"), F.lit(1.0 - w)) * F.pow(F.col("agreement_score"), F.lit(w)),
    )


# ---------------------------------------------------------- planning decisions
def requests_scfv_msa(binder_mode: str, use_msa: bool) -> bool:
    return binder_mode != "none" and (use_msa or binder_mode == "single_sequence")


def validation_skip_reason(
    df: DataFrame, token_limit: int | None, binder_mode: str = "none", use_msa: bool = False, use_template: str = "auto"
) -> Column:
    """NULL when a task can run. Needs ``scaffold``, ``has_template``, ``token_count``."""
    paired = F.lower(F.trim("scaffold")).isin("scfv", "sc_fv")
    out = F.when(paired & F.lit(requests_scfv_msa(binder_mode, use_msa)), "scFv binder MSA support is not implemented")
    no_template = F.lit(use_template == "false") | ~F.coalesce(F.col("has_template"), F.lit(False))
    out = out.when(paired & no_template, "scFv validation requires a bundled framework template")
    if token_limit is not None:
        text = F.concat(
            F.lit("validation input has "), F.col("token_count").cast("string"), F.lit(f" tokens, exceeding limit {token_limit}")
        )
        out = out.when(F.col("token_count") > token_limit, text)
    return out


def prefetch_decision(
    df: DataFrame, min_iptm: float | None, hotspot_mode: str = "auto", binder_mode: str = "none", use_msa: bool = False
) -> DataFrame:
    """``decision`` is ``queue`` or the reason why no alignment work is queued."""
    out = F.when(F.lit(False), "")
    if min_iptm is not None:
        low = F.coalesce(F.col("iptm") < min_iptm, F.lit(True))
        out = out.when(low, f"design below prefetch threshold {min_iptm:g}; no MSA queued")
    if hotspot_mode == "always":
        ok = F.coalesce(F.col("hotspot_pass"), F.col("hotspot_satisfaction").try_cast("double") > 0, F.lit(False))
        out = out.when(~ok, "design failed hotspot prefetch filter; no MSA queued")
    paired = F.lower(F.trim("scaffold")).isin("scfv", "sc_fv")
    out = out.when(
        paired & ~F.coalesce(F.col("has_template"), F.lit(False)),
        "scFv validation requires a bundled framework template; no MSA queued",
    )
    if requests_scfv_msa(binder_mode, use_msa):
        out = out.when(paired, "scFv binder MSA support is not implemented")
    return df.withColumn("decision", out.otherwise("queue"))


def valid_relpath(c: Column | str) -> Column:
    """Non-empty, relative, and never above the root while walking its parts."""
    path = F.coalesce(_c(c), F.lit(""))
    walk = F.aggregate(
        F.split(path, "/"),
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("low")),
        lambda acc, part: F.struct(
            (
                acc["depth"]
                + F.when(part.isin("", "."), 0).when(part == "..", -1).otherwise(1)
            ).alias("depth"),
            F.least(
                acc["low"],
                acc["depth"] + F.when(part.isin("", "."), 0).when(part == "..", -1).otherwise(1),
            ).alias("low"),
        ),
    )
    return (path != "") & ~path.startswith("/") & (walk["low"] >= 0)


# Names and order of the compact report. Empty optional columns are pruned at the sink.
COMPACT_FIELDS = (
    "rank", "design_name", "sequence", "binder_type", "framework", "binder_length", "consensus_score",
    "critic_rank", "critic_iptm", "validator_rank", "validator_iptm", "validator_ipsae", "binder_rmsd_angstrom",
    "critic_hotspot_distance_angstrom", "validator_hotspot_distance_angstrom", "critic_structure", "validator_structure",
)
COMPACT_SOURCE = {
    "rank": "final_rank", "design_name": "candidate_id", "sequence": "designed_sequence", "consensus_score": "final_score",
    "critic_rank": "selection_rank", "binder_rmsd_angstrom": "rmsd", "critic_structure": "source_structure_path",
    "validator_structure": "validated_structure_path",
}


def compact_sources(df: DataFrame) -> list[str]:
    """Columns of ``df`` that the compact report shows."""
    names = [COMPACT_SOURCE.get(name, name) for name in COMPACT_FIELDS]
    return [c for c in names if c in df.columns]


def compact_ranking(df: DataFrame) -> DataFrame:
    """Ranked rows under their short report names."""
    return df.select(*[F.col(COMPACT_SOURCE.get(n, n)).alias(n) for n in COMPACT_FIELDS if COMPACT_SOURCE.get(n, n) in df.columns])
