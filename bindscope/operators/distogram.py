"""Contact probabilities, confidence and losses from binned distance logits.

Input is long: one row per residue pair with ``logits array<double>``. ``mids`` are the
ascending bin centres, so every distance cutoff is a prefix of the bins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Entropy scale, loss weights and thresholds.
ENTROPY_BINS = 51
WEIGHTS = {"intra_contact": 0.5, "inter_contact": 0.5, "glob": 0.2}
PROXY_CUTOFF = 22.0


def default_midpoints() -> list[float]:
    """128 centres: 127 boundaries from 2 to 52, closed by 1 and 57."""
    edges = [1.0, *[2.0 + 50.0 * k / 126.0 for k in range(127)], 57.0]
    return [(a + b) / 2.0 for a, b in zip(edges, edges[1:])]


def _prefix(mids: Sequence[float], cutoff: float, inclusive: bool = False) -> int:
    n = sum(1 for m in mids if (m <= cutoff if inclusive else m < cutoff))
    if n == 0:
        raise ValueError("the cutoff does not include any bin")
    return n


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, v: a + v)


def _lits(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def weights(df: DataFrame, logits: str = "logits") -> DataFrame:
    """Adds shifted exponentials ``w`` and their total ``z``: softmax is ``w / z``."""
    top = df.withColumn("__top", F.array_max(logits))
    raised = top.withColumn("w", F.transform(logits, lambda v: F.exp(v - F.col("__top"))))
    return raised.withColumn("z", _sum(F.col("w")))


def _only(df: DataFrame, used: Column) -> DataFrame:
    """Logits are null, and cost nothing, where no figure uses the pair; the row itself remains."""
    return df.withColumn("logits", F.when(used, F.col("logits")))


def contact_probability(logits: DataFrame, mids: Sequence[float], cutoff: float, inclusive: bool = False) -> DataFrame:
    """Softmax mass of the bins below the cutoff (``inclusive``: at the cutoff too)."""
    n = _prefix(mids, cutoff, inclusive)
    return weights(logits).select("candidate_id", "i", "j", (_sum(F.slice("w", 1, n)) / F.col("z")).alias("p"))


def topk_contact(probs: DataFrame, k: int) -> DataFrame:
    """Per row residue the mean of its ``k`` largest probabilities (``k`` capped)."""
    if k <= 0:
        raise ValueError("k must be positive")
    held = probs.groupBy("candidate_id", "i").agg(F.slice(F.sort_array(F.collect_list("p"), False), 1, k).alias("top"))
    return held.select("candidate_id", "i", (_sum(F.col("top")) / F.size("top")).alias("score"))


def cdr_contact_summary(scores: DataFrame, framework_scores: DataFrame, threshold: float, hotspots: bool) -> DataFrame:
    """Range of the CDR scores and the mean squared framework excess."""
    cdr = scores.groupBy("candidate_id").agg(
        F.min("score").alias("probability_min"), F.avg("score").alias("probability_mean"), F.max("score").alias("probability_max")
    )
    excess = F.greatest(F.lit(0.0), F.col("score") - threshold)
    frame = framework_scores.groupBy("candidate_id").agg(
        F.avg(excess * excess).alias("framework_penalty"), F.max("score").alias("framework_probability_max")
    )
    label = "target_hotspots" if hotspots else "target_all"
    return cdr.join(frame, "candidate_id", "left").na.fill({"framework_penalty": 0.0}).withColumn("scope", F.lit(label))


def hotspot_hinge(scores: DataFrame, target: float) -> DataFrame:
    gap = F.greatest(F.lit(0.0), F.lit(target) - F.col("score")) / target
    return scores.groupBy("candidate_id").agg(F.avg(gap * gap).alias("hotspot_hinge"))


def _confidence(entropy: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - entropy / F.log(F.lit(float(ENTROPY_BINS)))))


def pair_entropy(logits: DataFrame, mids: Sequence[float], cutoff: float = PROXY_CUTOFF) -> DataFrame:
    """Entropy of the renormalised in-cutoff bins."""
    n = _prefix(mids, cutoff)
    base = weights(logits).withColumn("__w", F.slice("w", 1, n))
    base = base.withColumn("__mass", _sum(F.col("__w")) / F.col("z") + 1e-8)
    part = F.transform("__w", lambda v: v / F.col("z") / F.col("__mass"))
    return base.withColumn("__p", part).select(
        "candidate_id", "i", "j", (-_sum(F.transform("__p", lambda p: p * F.log(p + 1e-10)))).alias("entropy")
    )


def lowest_k_confidence(entropies: DataFrame, k: int, name: str) -> DataFrame:
    """Confidence from the mean of the ``k`` smallest pair entropies of a candidate."""
    w = Window.partitionBy("candidate_id").orderBy("entropy")
    low = entropies.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)
    return low.groupBy("candidate_id").agg(_confidence(F.avg("entropy")).alias(name))


def distogram_proxy(
    logits: DataFrame, mids: Sequence[float], target_length: int, binder_length: int, cdr: Sequence[int] | None = None
) -> DataFrame:
    """Proxy over all binder rows and, for antibodies, over the CDR rows."""
    cross = pair_entropy(logits.filter((F.col("i") >= target_length) & (F.col("j") < target_length)), mids)
    # The smallest of a row, then of all rows: each pair's softmax is taken once for both figures.
    least = cross.groupBy("candidate_id", "i").agg(F.slice(F.array_sort(F.collect_list("entropy")), 1, binder_length).alias("low"))
    inside = F.col("i").isin([target_length + c for c in cdr or ()])
    held = least.groupBy("candidate_id").agg(
        F.flatten(F.collect_list("low")).alias("all"), F.flatten(F.collect_list(F.when(inside, F.col("low")))).alias("cdr")
    )
    mean = lambda c, k: _sum(F.slice(F.array_sort(c), 1, k)) / F.size(F.slice(c, 1, k))
    own = F.when(F.size("cdr") > 0, _confidence(mean("cdr", len(cdr)))) if cdr else F.lit(None).cast("double")
    return held.select(
        "candidate_id", _confidence(mean("all", binder_length)).alias("distogram_iptm_proxy"), own.alias("cdr_distogram_iptm_proxy")
    )


def _cross_entropy(n: int) -> Column:
    """Of the first ``n`` bins: the sum of ``-w (v - top - log z)`` over the sum of ``w``, with the
    terms that all bins share taken out."""
    w = F.slice("w", 1, n)
    return F.col("__top") + F.log("z") - _sum(F.zip_with(w, F.slice("logits", 1, n), lambda w, v: w * v)) / _sum(w)


def binned_cross_entropy(logits: DataFrame, mids: Sequence[float], cutoff: float) -> DataFrame:
    """Cross-entropy of the in-cutoff distribution against the full one."""
    return weights(logits).select("candidate_id", "i", "j", _cross_entropy(_prefix(mids, cutoff)).alias("loss"))


def contact_loss(
    logits: DataFrame, mids: Sequence[float], rows: Column, cols: Column, k: int, cutoff: float, name: str, min_sep: int = 0
) -> DataFrame:
    """Mean over row residues of the ``k`` smallest masked pair losses.

    A row without an allowed column still counts, with 0; the small constant in both
    divisions is part of the definition.
    """
    used = cols if min_sep <= 0 else cols & (F.abs(F.col("i") - F.col("j")) >= min_sep)
    pair = binned_cross_entropy(_only(logits.filter(rows), used), mids, cutoff)
    low = pair.groupBy("candidate_id", "i").agg(F.slice(F.array_sort(F.collect_list("loss")), 1, k).alias("low"))
    per = low.select("candidate_id", (_sum(F.col("low")) / (F.size("low") + 1e-8)).alias("v"))
    return per.groupBy("candidate_id").agg((F.sum("v") / (F.count(F.lit(1)) + 1e-8)).alias(name))


@dataclass(frozen=True)
class ContactTerm:
    """A contact loss: which pairs are rows and columns, contacts per row, cutoff, least separation."""

    name: str
    rows: Column
    cols: Column
    k: int
    cutoff: float
    min_sep: int = 0


def hotspot_term(hotspots: Sequence[int], target_length: int, k: int, cutoff: float, binder_contacts: Sequence[int] | None = None) -> ContactTerm:
    """Loss of the target's hotspot rows towards the binder, or its contact residues."""
    cols = F.col("j") >= target_length if binder_contacts is None else F.col("j").isin([target_length + c for c in binder_contacts])
    return ContactTerm("hotspot_contact_loss", F.col("i").isin(list(hotspots)), cols, k, cutoff)


def cdr_term(cdr: Sequence[int], target_length: int, k: int, cutoff: float, hotspots: Sequence[int] = ()) -> ContactTerm:
    """Loss of the binder's CDR rows towards the target, or its hotspots if there are any."""
    cols = F.col("j").isin(list(hotspots)) if hotspots else F.col("j") < target_length
    return ContactTerm("cdr_contact_loss", F.col("i").isin([target_length + c for c in cdr]), cols, k, cutoff)


@dataclass(frozen=True)
class HingeTerm:
    """Hinge on the mean of a row's ``k`` largest contact probabilities."""

    rows: Column
    cols: Column
    k: int
    cutoff: float
    target: float


def structure_losses(
    logits: DataFrame, mids: Sequence[float], contacts: Sequence[ContactTerm], glob: tuple[Column, int] | None = None, hinge: HingeTerm | None = None
) -> DataFrame:
    """All losses of a structure that need its logits alone, from one softmax per pair: the named
    contact losses, ``glob_loss`` of the (binder pairs, length) and ``hotspot_hinge``. One
    aggregation per row of a structure, one per structure. A loss without rows is null."""
    def masked(t: ContactTerm) -> Column:
        both = t.rows & t.cols
        return both if t.min_sep <= 0 else both & (F.abs(F.col("i") - F.col("j")) >= t.min_sep)

    parts = [masked(t) for t in contacts]
    parts += [] if hinge is None else [hinge.rows & hinge.cols]
    parts += [] if glob is None else [glob[0] & (F.col("i") > F.col("j"))]
    base = weights(_only(logits, reduce(lambda a, b: a | b, parts, F.lit(False))))
    rows, per = [], []
    for t in contacts:
        low = F.slice(F.array_sort(F.collect_list(F.when(masked(t), _cross_entropy(_prefix(mids, t.cutoff))))), 1, t.k)
        rows += [low.alias(f"low_{t.name}"), F.bool_or(t.rows).alias(f"is_{t.name}")]
        value = F.when(F.col(f"is_{t.name}"), _sum(F.col(f"low_{t.name}")) / (F.size(f"low_{t.name}") + 1e-8))
        per.append((F.sum(value) / (F.count(value) + 1e-8)).alias(t.name))
    if hinge is not None:
        p = _sum(F.slice("w", 1, _prefix(mids, hinge.cutoff, True))) / F.col("z")
        rows.append(F.slice(F.sort_array(F.collect_list(F.when(hinge.rows & hinge.cols, p)), False), 1, hinge.k).alias("top"))
        gap = F.greatest(F.lit(0.0), F.lit(hinge.target) - _sum(F.col("top")) / F.size("top")) / hinge.target
        per.append(F.avg(F.when(F.size("top") > 0, gap * gap)).alias("hotspot_hinge"))
    if glob is not None:
        binder, length = glob
        sq = _lits([min(m, 27.0) ** 2 for m in mids])
        e = _sum(F.zip_with("w", sq, lambda w, d: w * d)) / F.col("z")
        rows.append(F.sum(F.when(binder & (F.col("i") > F.col("j")), e)).alias("spread"))
        x = F.sqrt(F.sum("spread") / float(length * length)) - 2.38 * length**0.365
        per.append(F.when(x > 0, x).otherwise(F.exp(x) - 1.0).alias("glob_loss"))
    return base.groupBy("candidate_id", "i").agg(*rows).groupBy("candidate_id").agg(*per)


def globularity(logits: DataFrame, mids: Sequence[float], binder: Column, length: int, cap: float = 27.0) -> DataFrame:
    """ELU of the radius of gyration over its expected value for this length."""
    sq = _lits([min(m, cap) ** 2 for m in mids])
    pairs = weights(logits.filter(binder & (F.col("i") > F.col("j"))))
    e = pairs.select("candidate_id", (_sum(F.zip_with("w", sq, lambda w, d: w * d)) / F.col("z")).alias("e"))
    rg = F.sqrt(F.sum("e") / float(length * length)) - 2.38 * length**0.365
    return e.groupBy("candidate_id").agg(rg.alias("x")).select(
        "candidate_id", F.when(F.col("x") > 0, F.col("x")).otherwise(F.exp("x") - 1.0).alias("glob_loss")
    )


def geometry_drift(
    logits: DataFrame, reference: DataFrame, mids: Sequence[float], tolerance: float, stiffness: float
) -> DataFrame:
    """RMS gap between expected and reference distance, and its hinge.

    ``reference`` has candidate_id, i, j, distance, mask.
    """
    if tolerance <= 0 or stiffness <= 0:
        raise ValueError("tolerance and stiffness must be positive")
    ref = reference.filter("mask").select("candidate_id", "i", "j", F.least("distance", F.lit(float(mids[-1]))).alias("ref"))
    # The expected distance is one number, the logits are many: it is taken before the join.
    e = _sum(F.zip_with("w", _lits(mids), lambda w, d: w * d)) / F.col("z")
    pairs = weights(logits).select("candidate_id", "i", "j", e.alias("e")).join(ref, ["candidate_id", "i", "j"])
    delta = pairs.select("candidate_id", F.pow(F.col("e") - F.col("ref"), 2).alias("sq"))
    rmse = delta.groupBy("candidate_id").agg(F.sqrt(F.avg("sq") + 1e-8).alias("drift_rmse"))
    return rmse.withColumn("drift_loss", F.greatest(F.lit(0.0), (F.col("drift_rmse") - tolerance) / stiffness))


@dataclass(frozen=True)
class ExtraWeights:
    drift: float = 0.0
    hotspot: float = 0.0
    cdr: float = 0.0
    hotspot_entropy: float = 0.0


def total_structure_score(parts: DataFrame, extra: ExtraWeights = ExtraWeights(), include_inter: bool = True) -> DataFrame:
    """Weighted sum of the loss columns present; absent terms count 0."""
    term = lambda c, w: F.coalesce(F.col(c), F.lit(0.0)) * w if c in parts.columns else F.lit(0.0)
    total = term("intra_contact_loss", WEIGHTS["intra_contact"]) + term("glob_loss", WEIGHTS["glob"])
    if include_inter:
        total = total + term("inter_contact_loss", WEIGHTS["inter_contact"])
    total = total + term("drift_loss", extra.drift) + term("hotspot_hinge", extra.hotspot) + term("cdr_contact_loss", extra.cdr)
    total = total + term("hotspot_contact_loss", extra.hotspot_entropy)
    return parts.withColumn("total_loss", total)
