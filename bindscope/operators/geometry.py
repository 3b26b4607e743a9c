"""Distances, contacts, superposition and pose agreement over long atom tables.

Structures are the unit of locality: every join carries ``structure_id`` (or a pair
id) and pair rows are aggregated where they are produced, never shuffled again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindscope.functions import scalars as S

XYZ = ("x", "y", "z")


def distance(a: Sequence[str] = ("ax", "ay", "az"), b: Sequence[str] = ("bx", "by", "bz")) -> Column:
    dx, dy, dz = (F.col(p) - F.col(q) for p, q in zip(a, b, strict=True))
    return F.sqrt(dx * dx + dy * dy + dz * dz)


def _side(df: DataFrame, prefix: str, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    cols = [F.col(k) for k in keys]
    cols += [F.col(c).alias(f"{prefix}{c}") for c in (*carry, *XYZ)]
    return df.select(*cols)


# ------------------------------------------------------------------- chains
def pick_binder(chains: DataFrame, by: Sequence[str], wanted_id: str, wanted_sequence: str) -> DataFrame:
    """Binder chain by id, else exact sequence, else equal length, else the first chain."""
    have, want = S.alpha_sequence("sequence"), S.alpha_sequence(wanted_sequence)
    score = (
        F.when((F.col(wanted_id) != "") & (F.col("chain") == F.col(wanted_id)), 0)
        .when((want != "") & (have == want), 1)
        .when((want != "") & (F.length(have) == F.length(want)), 2)
        .otherwise(3)
    )
    w = Window.partitionBy(*by).orderBy("__score", "chain_order")
    return chains.withColumn("__score", score).withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn", "__score")


def match_chains(src: DataFrame, dst: DataFrame, by: str) -> DataFrame:
    """Pair target chains in source order: the first unused equal sequence, else the
    smallest length difference (the first on ties).

    The few chains of one structure are folded as arrays; nothing leaves the JVM.
    """
    def packed(df: DataFrame, name: str) -> DataFrame:
        item = F.struct("chain_order", "chain", S.alpha_sequence("sequence").alias("sequence"))
        return df.groupBy(by).agg(F.array_sort(F.collect_list(item)).alias(name))

    both = packed(src, "s").join(packed(dst, "d"), by)
    start = F.struct(F.col("d").alias("unused"), F.array().cast("array<struct<src_chain:string,dst_chain:string>>").alias("pairs"))

    def step(acc: Column, item: Column) -> Column:
        gap = lambda c: F.abs(F.length(item["sequence"]) - F.length(c["sequence"]))
        same = lambda c: (item["sequence"] != "") & (c["sequence"] == item["sequence"])
        costs = F.transform(acc["unused"], lambda c: F.when(same(c), -1).otherwise(gap(c)))
        at = (F.array_position(costs, F.array_min(costs)) - 1).cast("int")
        pair = F.struct(item["chain"].alias("src_chain"), F.get(acc["unused"], at)["chain"].alias("dst_chain"))
        taken = F.struct(
            F.filter(acc["unused"], lambda c, i: i != at).alias("unused"), F.concat(acc["pairs"], F.array(pair)).alias("pairs")
        )
        return F.when(F.size(acc["unused"]) > 0, taken).otherwise(acc)

    matched = both.select(by, F.aggregate("s", start, step)["pairs"].alias("pairs"))
    return matched.select(by, F.inline("pairs"))


def zip_atoms(a: DataFrame, b: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Pair two atom lists by position, cut to the shorter one."""
    keys = [*by, "ordinal"]
    w = Window.partitionBy(*by).orderBy(order)
    left = _side(a.withColumn("ordinal", F.row_number().over(w)), "a", keys)
    right = _side(b.withColumn("ordinal", F.row_number().over(w)), "b", keys)
    return left.join(right, keys)


def representatives(atoms: DataFrame, by: Sequence[str]) -> DataFrame:
    """CB per residue, or CA for glycine and residues without CB."""
    best = F.when((F.col("atom_name") == "CB") & (F.col("res_name") != "GLY"), 2).when(F.col("atom_name") == "CA", 1)
    held = atoms.withColumn("__p", best).filter("__p is not null")
    picked = held.groupBy(*by).agg(F.max_by(F.struct(*XYZ, "atom_name"), "__p").alias("r"))
    return picked.select(*by, *[F.col(f"r.{c}").alias(c) for c in (*XYZ, "atom_name")])


# ---------------------------------------------------------------- pair tables
def distogram(residues: DataFrame, by: str = "structure_id", index: str = "residue", chains: tuple[str, str] | None = None) -> DataFrame:
    """All residue pairs of a structure, or of two chains, with distance and mask."""
    left = _side(residues, "a", [by], [index, "chain"])
    right = _side(residues, "b", [by], [index, "chain"])
    pairs = left.join(right, by)
    if chains is None:
        pairs = pairs.filter(F.col("achain") == F.col("bchain"))
    else:
        pairs = pairs.filter((F.col("achain") == chains[0]) & (F.col("bchain") == chains[1]))
    d = distance()
    return pairs.select(
        by, F.col(f"a{index}").alias("i"), F.col(f"b{index}").alias("j"), F.col("achain").alias("chain_i"),
        F.col("bchain").alias("chain_j"), F.coalesce(d, F.lit(0.0)).alias("distance"), d.isNotNull().alias("mask"),
    )


def contact_pairs(atoms: DataFrame, cutoff: float, by: str = "structure_id", index: str = "residue") -> DataFrame:
    """Directed inter-chain pairs within ``cutoff``.

    Atoms are hashed to cubes of edge ``cutoff``; only neighbouring cubes are joined, so work
    follows the number of near pairs and not the square of the length. Of two neighbours one
    looks at the other: an atom goes to its own cube and to 13 of the 26 around it, and a pair
    found there counts in both directions. The copies are rows that Spark's estimates do not
    see, so the join is always shuffled; broadcast, they would all pass through the driver.
    """
    cell = lambda c: F.floor(F.col(c) / cutoff).cast("int")
    base = atoms.filter(F.col("x").isNotNull()).select(by, index, "chain", *XYZ, *[cell(c).alias(f"c{c}") for c in XYZ])
    ahead = [s for s in product((-1, 0, 1), repeat=3) if s >= (0, 0, 0)]
    steps = F.array(*[F.struct(*[F.lit(k).alias(f"s{c}") for c, k in zip(XYZ, s, strict=True)]) for s in ahead])
    near = base.withColumn("__s", F.explode(steps)).withColumn("__own", F.expr("__s.sx = 0 and __s.sy = 0 and __s.sz = 0"))
    near = near.withColumns({f"c{c}": F.col(f"c{c}") + F.col(f"__s.s{c}") for c in XYZ})
    keys = [by, "cx", "cy", "cz"]
    left, right = _side(near, "a", [*keys, "__own"], [index, "chain"]), _side(base, "b", keys, [index, "chain"])
    pairs = left.hint("merge").join(right, keys).filter(F.col("achain") != F.col("bchain")).withColumn("distance", distance())
    one = lambda a, b: F.struct(
        F.col(f"{a}{index}").alias("i"), F.col(f"{b}{index}").alias("j"), F.col(f"{a}chain").alias("chain_i"), F.col(f"{b}chain").alias("chain_j")
    )
    found = F.when(F.col("__own"), F.array(one("a", "b"))).otherwise(F.array(one("a", "b"), one("b", "a")))
    return pairs.filter(F.col("distance") <= cutoff).select(by, F.inline(found), "distance")


def hotspot_distances(atoms: DataFrame, hotspots: DataFrame, binder: Column, by: str = "structure_id") -> DataFrame:
    """Smallest binder distance of every hotspot residue; NULL when a residue has no atoms."""
    spots = hotspots.select(by, "chain", "residue").distinct()
    target = _side(atoms.filter(~binder).join(spots, [by, "chain", "residue"], "left_semi"), "a", [by, "chain", "residue"])
    pairs = target.join(_side(atoms.filter(binder), "b", [by]), by)
    nearest = pairs.groupBy(by, "chain", "residue").agg(F.min(distance()).alias("distance"))
    return spots.join(nearest, [by, "chain", "residue"], "left")


def score_hotspots(atoms: DataFrame, hotspots: DataFrame, binder: Column, cutoff: float, by: str = "structure_id") -> DataFrame:
    """Pass/fail per structure with the nearest distance, missing residues and a reason."""
    per = hotspot_distances(atoms, hotspots, binder, by)
    held = atoms.filter(binder).select(by).distinct().withColumn("__binder", F.lit(True))
    missing = F.when(F.col("distance").isNull(), F.struct("chain", "residue"))
    agg = per.groupBy(by).agg(
        F.min("distance").alias("hotspot_distance"), F.count(F.lit(1)).alias("hotspot_count"),
        F.array_sort(F.collect_list(missing)).alias("__missing"),
    ).join(held, by, "left")
    text = F.array_join(F.transform("__missing", lambda m: F.concat_ws(":", m["chain"], (m["residue"] + 1).cast("string"))), ", ")
    passed = F.coalesce(F.col("hotspot_distance") <= cutoff, F.lit(False))
    reason = (
        F.when(F.col("__binder").isNull(), "no binder heavy atoms found")
        .when(F.col("hotspot_distance").isNull(), "no target hotspot heavy atoms found")
        .when(
            ~passed,
            F.concat(
                F.lit("validation hotspot distance "), S.fixed_text("hotspot_distance", 4), F.lit(f" exceeds cutoff {cutoff:.4f}")
            ),
        )
    )
    return agg.select(
        by, "hotspot_distance", "hotspot_count", passed.alias("hotspot_pass"),
        F.size("__missing").alias("missing_count"), text.alias("missing_residues"), reason.alias("hotspot_fail_reason"),
    )


#: Bits of a pair of atoms: any, binder atom in a selected region, both representative, both of these.
VARIANTS = {"whole": 1, "region": 2, "representative": 4, "region_representative": 8}


def hotspot_variants(
    atoms: DataFrame, hotspots: DataFrame, binder: Column, region: Column, representative: Column, cutoff: float, by: str = "structure_id"
) -> DataFrame:
    """Contact figures of all variants from one join of hotspot and binder atoms: over all heavy
    atoms, over the binder's ``region`` (its CDRs), over representative atoms, and over both;
    for the structure (chain null) and for each target chain.

    A pair carries one bit per variant it belongs to. The nearest distance of a hotspot residue
    is a minimum per bit, the figures of chain and structure are two grouping sets of these."""
    spots = hotspots.select(by, "chain", "residue").distinct()
    marked = atoms.filter(F.col("x").isNotNull()).select(
        by, "chain", "residue", *XYZ, binder.alias("__b"), F.coalesce(region, F.lit(False)).alias("__region"), F.coalesce(representative, F.lit(False)).alias("__rep")
    )
    target = _side(marked.filter(~F.col("__b")).join(spots, [by, "chain", "residue"], "left_semi"), "a", [by, "chain", "residue"], ["__rep"])
    own = _side(marked.filter("__b"), "b", [by], ["__region", "__rep"])
    both, part = F.col("a__rep") & F.col("b__rep"), F.col("b__region")
    bit = lambda cond, n: F.when(cond, n).otherwise(0)
    mask = F.lit(1) + bit(part, 2) + bit(both, 4) + bit(both & part, 8)
    pairs = target.join(own, by).select(by, "chain", "residue", mask.alias("mask"), distance().alias("d"))
    nearest = pairs.groupBy(by, "chain", "residue").agg(
        *[F.min(F.when(F.col("mask").bitwiseAND(n) > 0, F.col("d"))).alias(v) for v, n in VARIANTS.items()]
    )
    # A residue stays in if it has atoms; a variant without pairs gives no distance.
    long = nearest.select(by, "chain", F.inline(F.array(*[F.struct(F.lit(v).alias("variant"), F.col(v).alias("d")) for v in VARIANTS])))
    sets = long.filter("d is not null").groupingSets([[by, "variant"], [by, "chain", "variant"]], by, "chain", "variant")
    return sets.agg(
        F.avg((F.col("d") <= cutoff).cast("double")).alias("contact_fraction"), F.avg("d").alias("min_distance_mean"),
        F.min("d").alias("min_distance_min"), F.count(F.lit(1)).alias("hotspot_count"), F.coalesce(F.min("d") <= cutoff, F.lit(False)).alias("hotspot_pass"),
    )


def hotspot_contact_metrics(atoms: DataFrame, hotspots: DataFrame, binder: Column, cutoff: float, by: Sequence[str] = ("structure_id",)) -> DataFrame:
    """Contact fraction, mean and minimum of the per-hotspot nearest distances."""
    per = hotspot_distances(atoms, hotspots, binder).filter("distance is not null")
    return per.groupBy(*by).agg(
        F.avg((F.col("distance") <= cutoff).cast("double")).alias("contact_fraction"),
        F.avg("distance").alias("min_distance_mean"), F.min("distance").alias("min_distance_min"),
        F.count(F.lit(1)).alias("hotspot_count"),
    )


# ------------------------------------------------------- predicted vs reference
def paired_distances(pred: DataFrame, ref: DataFrame, by: str, index: str = "residue") -> DataFrame:
    """Distances of the same residue pairs in two structures, resolved residues only. Each pair
    comes once, in the order of (chain, number), and each residue once with itself."""
    keys = [by, "chain", index]
    both = _side(pred, "p", keys).join(_side(ref, "r", keys), keys).filter("px is not null and rx is not null")
    cols = ["px", "py", "pz", "rx", "ry", "rz"]
    left = both.select(by, F.col("chain").alias("chain_i"), F.col(index).alias("i"), *[F.col(c).alias(f"a{c}") for c in cols])
    right = both.select(by, F.col("chain").alias("chain_j"), F.col(index).alias("j"), *[F.col(c).alias(f"b{c}") for c in cols])
    d = lambda k: distance([f"a{k}{c}" for c in XYZ], [f"b{k}{c}" for c in XYZ])
    met = left.join(right, by).filter(F.struct("chain_i", "i") <= F.struct("chain_j", "j"))
    return met.select(by, "chain_i", "chain_j", "i", "j", d("p").alias("dp"), d("r").alias("dr"))


def rmse_of_pairs(mode: str = "full") -> Column:
    """``full`` counts each pair in both directions and the zero diagonal, ``upper`` each pair
    once without it. A single residue has no value. Pairs are told apart by chain and number,
    as numbers may begin anew in each chain."""
    own = (F.col("chain_i") == F.col("chain_j")) & (F.col("i") == F.col("j"))
    total = F.sum(F.pow(F.col("dp") - F.col("dr"), 2))
    if mode == "upper":
        return F.sqrt(F.try_divide(total, F.count_if(~own)))
    n = F.count_if(own)
    return F.when(n > 1, F.sqrt(F.try_divide(2.0 * total, n * n)))


def distance_rmse(pairs: DataFrame, by: Sequence[str], mode: str = "full") -> DataFrame:
    return pairs.groupBy(*by).agg(rmse_of_pairs(mode).alias("distance_rmse"))


def contact_recovery(pairs: DataFrame, by: Sequence[str], cutoffs: Sequence[float] = (8.0, 12.0)) -> DataFrame:
    aggs = []
    for c in cutoffs:
        near = F.col("dr") <= c
        aggs.append(F.try_divide(F.count_if(near & (F.col("dp") <= c)), F.count_if(near)).alias(f"contact_recovery_{c:g}"))
    return pairs.groupBy(*by).agg(*aggs)


#: Squarings of the quaternion matrix: they part eigenvalues that differ in the last bits.
SQUARINGS = 60
_UPPER = [(i, j) for i in range(4) for j in range(i, 4)]


def _at(m: Column, i: int, j: int) -> Column:
    return F.get(m, F.lit(_UPPER.index((min(i, j), max(i, j)))))


def _sum(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def _squared(m: Column) -> Column:
    """The square of a symmetric 4x4 matrix, kept as its upper part, divided by its trace."""
    square = [_sum([_at(m, i, k) * _at(m, k, j) for k in range(4)]) for i, j in _UPPER]
    trace = _sum([_at(m, i, j) * _at(m, i, j) * (1.0 if i == j else 2.0) for i, j in _UPPER])
    return F.transform(F.array(*square), lambda v: v / trace)


def kabsch3(cov: Column) -> Column:
    """Proper rotation, row-major, that turns moving rows onto fixed ones best, from their
    row-major 3x3 moving-by-fixed covariance.

    The best rotation's quaternion is the leading eigenvector of a symmetric 4x4 matrix of
    the nine sums. The matrix is shifted to have no negative eigenvalue and squared again and
    again, which leaves the projection onto the leading eigenvector; where several rotations
    are equally good (points on a line, or in one place), onto their space, and any vector of
    it will do. All in column expressions, one row per superposition.
    """
    s = lambda a, b: F.get(cov, F.lit(3 * a + b))
    diagonal = [s(0, 0) + s(1, 1) + s(2, 2), s(0, 0) - s(1, 1) - s(2, 2), s(1, 1) - s(0, 0) - s(2, 2), s(2, 2) - s(0, 0) - s(1, 1)]
    upper = {
        (0, 1): s(1, 2) - s(2, 1), (0, 2): s(2, 0) - s(0, 2), (0, 3): s(0, 1) - s(1, 0),
        (1, 2): s(0, 1) + s(1, 0), (1, 3): s(2, 0) + s(0, 2), (2, 3): s(1, 2) + s(2, 1),
    }
    entries = F.array(*[diagonal[i] if i == j else upper[i, j] for i, j in _UPPER])

    def unit(m: Column) -> Column:
        size = F.sqrt(_sum([_at(m, i, j) * _at(m, i, j) * (1.0 if i == j else 2.0) for i, j in _UPPER]))
        scaled = [F.when(size > 0, _at(m, i, j) / size).otherwise(0.0) + (1.0 if i == j else 0.0) for i, j in _UPPER]
        return F.array(*scaled)

    def turn(p: Column) -> Column:
        top = F.greatest(*[_at(p, i, i) for i in range(4)])
        column = F.coalesce(*[F.when(_at(p, j, j) == top, F.array(*[_at(p, i, j) for i in range(4)])) for j in range(4)])
        norm = lambda q: F.sqrt(_sum([F.get(q, F.lit(i)) * F.get(q, F.lit(i)) for i in range(4)]))

        def matrix(q: Column) -> Column:
            w, x, y, z = (F.get(q, F.lit(i)) for i in range(4))
            return F.array(
                w * w + x * x - y * y - z * z, 2.0 * (x * y + w * z), 2.0 * (x * z - w * y),
                2.0 * (x * y - w * z), w * w - x * x + y * y - z * z, 2.0 * (y * z + w * x),
                2.0 * (x * z + w * y), 2.0 * (y * z - w * x), w * w - x * x - y * y + z * z,
            )

        return _with(_with(column, lambda q: F.transform(q, lambda v: v / norm(q))), matrix)

    powers = F.aggregate(F.sequence(F.lit(1), F.lit(SQUARINGS)), _with(entries, unit), lambda m, _: _squared(m))
    return _with(powers, turn)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def superposition(pairs: DataFrame, by: Sequence[str], min_pairs: int) -> DataFrame:
    """Centroids and rotation that move ``m*`` onto ``f*``, from sums alone; groups with fewer
    points have no rotation."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(f"{s}{c}").alias(f"{s}c{c}") for s in "mf" for c in XYZ]
    aggs += [F.covar_pop(f"m{a}", f"f{b}").alias(f"v{a}{b}") for a in XYZ for b in XYZ]
    sums = pairs.groupBy(*by).agg(*aggs)
    cov = F.array(*[F.col(f"v{a}{b}") for a in XYZ for b in XYZ])
    keep = [f"{s}c{c}" for s in "mf" for c in XYZ]
    return sums.select(*by, "n", *keep, F.when(F.col("n") >= min_pairs, kabsch3(cov)).alias("rot"))


def apply_rotation(df: DataFrame) -> DataFrame:
    """Adds ``tx, ty, tz``: the moving point after superposition."""
    centred = [F.col(f"m{c}") - F.col(f"mc{c}") for c in XYZ]
    out = df
    for k, c in enumerate(XYZ):
        turned = sum((centred[r] * F.get("rot", F.lit(3 * r + k)) for r in range(1, 3)), centred[0] * F.get("rot", F.lit(k)))
        out = out.withColumn(f"t{c}", turned + F.col(f"fc{c}"))
    return out


def _rmsd() -> Column:
    return F.sqrt(F.avg(_sum([F.pow(F.col(f"t{c}") - F.col(f"f{c}"), 2) for c in XYZ])))


def aligned_rmsd(pairs: DataFrame, by: Sequence[str], min_pairs: int = 2) -> DataFrame:
    moved = apply_rotation(pairs.join(superposition(pairs, by, min_pairs).filter("rot is not null"), list(by)))
    return moved.groupBy(*by).agg(_rmsd().alias("aligned_rmsd"), F.count(F.lit(1)).alias("residue_count"))


def aligned_pairs(pred: DataFrame, ref: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Resolved residues of both sides as moving (predicted) and fixed (reference) points."""
    both = _side(pred, "m", keys).join(_side(ref, "f", keys), list(keys))
    return both.filter("mx is not null and fx is not null")


def geometry_diagnostics(pred: DataFrame, ref: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """Per chain: RMSE, aligned RMSD, counts. Per chain pair: RMSE and contact recovery."""
    pairs = paired_distances(pred, ref, by)
    near = lambda c: F.col("dr") <= c
    each = pairs.groupBy(by, "chain_i", "chain_j").agg(
        rmse_of_pairs("full").alias("distance_rmse"), rmse_of_pairs("upper").alias("pair_distance_rmse"),
        *[F.try_divide(F.count_if(near(c) & (F.col("dp") <= c)), F.count_if(near(c))).alias(f"contact_recovery_{c:g}") for c in (8.0, 12.0)],
        F.count(F.lit(1)).alias("residue_pair_count"),
    )
    chain = each.filter("chain_i = chain_j").select(by, F.col("chain_i").alias("chain"), "distance_rmse")
    fit = aligned_rmsd(aligned_pairs(pred, ref, [by, "chain", "residue"]), [by, "chain"])
    return chain.join(fit, [by, "chain"], "full_outer"), each.filter("chain_i <> chain_j").drop("distance_rmse")


def pose_agreement(target_pairs: DataFrame, binder_pairs: DataFrame, ids: DataFrame, by: str) -> DataFrame:
    """Superpose on target CA pairs and measure the binder there.

    ``target_pairs`` and ``binder_pairs`` hold zipped points ``m*`` (validator) and
    ``f*`` (source); binder rows also carry ``is_ca``. Every id of ``ids`` is kept and
    problems become text.
    """
    fit = superposition(target_pairs, [by], 3)
    names = [by, *[f"{s}{c}" for s in "mf" for c in XYZ]]
    part = lambda df, kind, ca: df.select(*names, F.lit(kind).alias("part"), ca.alias("is_ca"))
    points = part(target_pairs, "target", F.lit(False)).unionByName(part(binder_pairs, "binder", F.coalesce("is_ca", F.lit(False))))
    moved = apply_rotation(points.join(fit, by))
    sq = _sum([F.pow(F.col(f"t{c}") - F.col(f"f{c}"), 2) for c in XYZ])
    ca, binder = F.col("is_ca"), F.col("part") == "binder"
    mean = lambda p, c: F.avg(F.when(ca, F.col(f"{p}{c}")))
    root = lambda cond: F.sqrt(F.avg(F.when(cond, sq)))
    found = moved.groupBy(by).agg(
        root(~binder).alias("target_aligned_rmsd"), root(ca).alias("binder_ca_rmsd"), root(binder).alias("binder_backbone_rmsd"),
        F.sqrt(_sum([F.pow(mean("t", c) - mean("f", c), 2) for c in XYZ])).alias("binder_centroid_distance"), F.max("n").alias("__n"),
    )
    out = ids.join(found, by, "left")
    error = F.when(F.col("__n").isNull(), "could not match target chains").when(F.col("__n") < 3, "insufficient matched target CA atoms")
    return out.withColumn("pose_error", error).drop("__n")
