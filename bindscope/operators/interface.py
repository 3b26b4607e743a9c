"""Interface scores from predicted aligned error, distances and confidence.

The error matrix is kept as its rows: one per structure and residue, with the errors
towards all residues of the complex and the spans of its chains. Blocks towards another
chain are slices, so all that one residue needs is computed where its row is read. Only
sums and bitmaps of touched partners are exchanged for the figures of a chain pair; pair
rows never are.

A row: ``structure_id``, ``chain``, ``i`` (the residue's number in its chain), ``errors``,
``spans``: an array of (chain, start, length, first, residues), where ``start`` is the
chain's offset in ``errors``, ``first`` the number of its first residue, ``length`` how many
numbers it spans and ``residues`` how many of these exist. A missing error is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindscope.functions import scalars as S

# Residue names of nucleic acids and the published score constants.
NUCLEIC = ("DA", "DC", "DT", "DG", "A", "C", "U", "G")
PDOCKQ = (0.724, 0.052, 152.611, 0.018)
PDOCKQ2 = (1.31, 0.075, 84.733, 0.005)
LIS_CUTOFF = 12.0

PAIR = ("structure_id", "chain_i", "chain_j")


def chain_types(residues: DataFrame) -> DataFrame:
    nucleic = F.col("res_name").isin(*NUCLEIC)
    return residues.groupBy("structure_id", "chain").agg(
        F.when(F.bool_or(nucleic), "nucleic_acid").otherwise("protein").alias("chain_type")
    )


def pair_types(types: DataFrame) -> DataFrame:
    a = types.select("structure_id", F.col("chain").alias("chain_i"), F.col("chain_type").alias("ta"))
    b = types.select("structure_id", F.col("chain").alias("chain_j"), F.col("chain_type").alias("tb"))
    nucleic = (F.col("ta") == "nucleic_acid") | (F.col("tb") == "nucleic_acid")
    return a.join(b, "structure_id").filter("chain_i <> chain_j").select(
        *PAIR, F.when(nucleic, "nucleic_acid").otherwise("protein").alias("pair_type")
    )


SPANS = "array<struct<chain:string,start:int,length:int,first:bigint,residues:int>>"


def rows_of_pairs(pae: DataFrame) -> DataFrame:
    """Matrix rows of a table of inter-chain pairs (structure_id, chain_i, chain_j, i, j, pae),
    for sources that come in that form. Gaps in the numbering become null errors."""
    ends = pae.groupBy("structure_id", F.col("chain_j").alias("chain")).agg(
        F.min("j").alias("first"), F.max("j").alias("last"), F.count_distinct("j").cast("int").alias("residues")
    )
    listed = ends.groupBy("structure_id").agg(F.array_sort(F.collect_list(F.struct("chain", "first", "last", "residues"))).alias("c"))
    width = lambda e: (e["last"] - e["first"] + 1).cast("int")
    spans = F.transform("c", lambda e, k: F.struct(
        e["chain"].alias("chain"), F.aggregate(F.slice("c", F.lit(1), k), F.lit(0), lambda acc, x: acc + width(x)).alias("start"),
        width(e).alias("length"), e["first"].alias("first"), e["residues"].alias("residues"),
    ))
    cells = pae.groupBy("structure_id", F.col("chain_i").alias("chain"), "i").agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("chain_j", "j").alias("k"), F.col("pae").alias("v")))).alias("m")
    )
    rows = cells.join(listed.select("structure_id", spans.cast(SPANS).alias("spans")), "structure_id")
    errors = F.flatten(F.transform("spans", lambda e: F.transform(
        F.sequence(e["first"], e["first"] + e["length"] - 1), lambda j: F.try_element_at("m", F.struct(e["chain"].alias("chain_j"), j.alias("j")))
    )))
    return rows.select("structure_id", "chain", "i", errors.alias("errors"), "spans")


def pae_blocks(rows: DataFrame) -> DataFrame:
    """A row per residue and other chain: the errors ``paes`` towards it, numbered from ``first_j``."""
    own = F.filter("spans", lambda s: s["chain"] == F.col("chain"))[0]
    others = F.filter("spans", lambda s: s["chain"] != F.col("chain"))
    out = rows.select("structure_id", F.col("chain").alias("chain_i"), "i", "errors", own["residues"].alias("len_i"), F.explode(others).alias("s"))
    return out.select(
        "structure_id", "chain_i", F.col("s.chain").alias("chain_j"), "i", "len_i", F.col("s.residues").alias("len_j"),
        F.col("s.first").alias("first_j"), F.slice("errors", F.col("s.start") + 1, F.col("s.length")).alias("paes"),
    )


def _sum(values: Column, term) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + term(x))


def _kernel_mean(values: Column, scale: Column) -> Column:
    """Mean of 1/(1+(x/d0)^2); 0 for no values."""
    total = _sum(values, lambda x: F.lit(1.0) / (F.lit(1.0) + (x / scale) * (x / scale)))
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(0.0)


def _bitmap(flags: Column) -> Column:
    """Flags as 64-bit words."""
    def word(w: Column) -> Column:
        bits = F.slice(flags, w * 64 + 1, F.lit(64))
        start = F.struct(F.lit(0).cast("long").alias("word"), F.lit(0).alias("at"))
        add = lambda acc, x: F.struct(
            F.when(x, acc["word"].bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), acc["at"]))).otherwise(acc["word"]).alias("word"),
            (acc["at"] + 1).alias("at"),
        )
        return F.aggregate(bits, start, add, lambda acc: acc["word"])

    return F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(flags), F.lit(1)) - 1) / 64).cast("int")), word)


def touched(blocks: DataFrame, flags: Column) -> DataFrame:
    """Per chain pair: pairs flagged, residues of this side with one, residues of the other
    side touched by any (the bits of all bitmaps together)."""
    one = blocks.select(*PAIR, F.size(F.filter(flags, lambda x: x)).alias("hits"), F.posexplode(_bitmap(flags)).alias("w", "bits"))
    words = one.groupBy(*PAIR, "w").agg(
        F.bit_or("bits").alias("bits"), F.count_if(F.col("hits") > 0).alias("touch_i"), F.sum("hits").alias("pair_count")
    )
    return words.groupBy(*PAIR).agg(
        F.max("pair_count").alias("pair_count"), F.max("touch_i").alias("touch_i"), F.sum(F.bit_count("bits")).alias("touch_j")
    )


def _below(cutoff: float) -> Column:
    return F.transform("paes", lambda x: F.coalesce(x < cutoff, F.lit(False)))


def _near(blocks: DataFrame, contacts: DataFrame) -> DataFrame:
    """Adds ``near``: offsets in ``paes`` of the residues in contact."""
    near = contacts.groupBy(*PAIR, "i").agg(F.array_sort(F.collect_list("j")).alias("js"))
    out = blocks.join(near.hint("merge"), [*PAIR, "i"], "left")  # a row per residue: never through the driver
    at = F.transform("js", lambda j: (j - F.col("first_j")).cast("int"))
    return out.withColumn("near", F.coalesce(at, F.array().cast("array<int>"))).drop("js")


def by_residue(rows: DataFrame, cutoff: float, nucleic: DataFrame | None = None, contacts: DataFrame | None = None) -> DataFrame:
    """Per residue and other chain: counts, scales, the four means and the sums of the local
    interaction score; with ``contacts`` also the number of contacts and the sums of their
    kernel. Reads the matrix twice: for the touched partners of a pair, and for the means."""
    blocks = pae_blocks(rows)
    sides = touched(blocks, _below(cutoff)).select(*PAIR, F.col("touch_i").cast("long"), F.col("touch_j").cast("long"))
    if contacts is not None:
        blocks = _near(blocks, contacts)
    res = blocks.join(sides, list(PAIR))
    if nucleic is not None:
        res = res.join(nucleic, list(PAIR), "left")
        na = F.coalesce(F.col("pair_type") == "nucleic_acid", F.lit(False))
    else:
        na = F.lit(False)
    res = (
        res.withColumn("known", F.filter("paes", F.isnotnull)).withColumn("valid", F.filter("paes", lambda x: x < cutoff))
        .withColumn("n0res", F.size("valid")).withColumn("n0chn", (F.col("len_i") + F.col("len_j")).cast("long"))
        .withColumn("n0dom", F.col("touch_i") + F.col("touch_j"))
        .withColumn("d0chn", S.d0(F.col("n0chn"), na)).withColumn("d0dom", S.d0(F.col("n0dom"), na)).withColumn("d0res", S.d0(F.col("n0res"), na))
    )
    extra = []
    if contacts is not None:
        found = F.filter(F.transform("near", lambda k: F.get("paes", k)), F.isnotnull)
        extra = [F.size("near").alias("n_near"), F.size(found).alias("n_kernel"),
                 _sum(found, lambda x: F.lit(1.0) / (F.lit(1.0) + (x / 10.0) * (x / 10.0))).alias("kernel")]
    return res.select(
        *PAIR, "i", "n0res", "n0chn", "n0dom", "d0res", "d0chn", "d0dom", "touch_i", "touch_j",
        _kernel_mean(F.col("known"), F.col("d0chn")).alias("iptm_d0chn"), _kernel_mean(F.col("valid"), F.col("d0chn")).alias("ipsae_d0chn"),
        _kernel_mean(F.col("valid"), F.col("d0dom")).alias("ipsae_d0dom"), _kernel_mean(F.col("valid"), F.col("d0res")).alias("ipsae"),
        *_lis_sums(), *extra,
    )


def _lis_sums() -> list[Column]:
    near = F.filter("paes", lambda x: x <= LIS_CUTOFF)
    return [_sum(near, lambda x: (F.lit(LIS_CUTOFF) - x) / LIS_CUTOFF).alias("lis_sum"), F.size(near).alias("lis_n")]


def asym_scores(res: DataFrame) -> DataFrame:
    """Best residue per directed chain pair and score, and the pair's local interaction score.

    A score of 0 has no residue: the first residue of the complex would be meaningless.
    """
    names = ("ipsae", "ipsae_d0chn", "ipsae_d0dom", "iptm_d0chn")
    aggs = [F.max(F.struct(F.col(n), (-F.col("i")).alias("neg"), "n0res", "d0res")).alias(n) for n in names]
    agg = res.groupBy(*PAIR).agg(
        *aggs, *[F.max(c).alias(c) for c in ("n0chn", "n0dom", "d0chn", "d0dom", "touch_i", "touch_j")], _lis().alias("lis")
    )
    cols = []
    for n in names:
        cols.append(F.col(f"{n}.{n}").alias(n))
        cols.append(F.when(F.col(f"{n}.{n}") > 0, -F.col(f"{n}.neg")).alias(f"{n}_residue"))
    return agg.select(
        *PAIR, *cols, F.col("ipsae.n0res").alias("n0res"), F.col("ipsae.d0res").alias("d0res"),
        "n0chn", "n0dom", "d0chn", "d0dom", F.col("touch_i").alias("nres1"), F.col("touch_j").alias("nres2"), "lis",
    )


def iptm_d0chn(rows: DataFrame) -> DataFrame:
    """Score over the whole partner chain, without an error cutoff: the scale follows from
    the chains' lengths, so a residue's value is computed where its row is read."""
    blocks = pae_blocks(rows).withColumn("d0chn", S.d0(F.col("len_i") + F.col("len_j")))
    value = _kernel_mean(F.filter("paes", F.isnotnull), F.col("d0chn"))
    best = blocks.select(*PAIR, "i", value.alias("value")).groupBy(*PAIR).agg(F.max(F.struct("value", (-F.col("i")).alias("neg"))).alias("b"))
    return best.select(*PAIR, F.col("b.value").alias("iptm_d0chn"), (-F.col("b.neg")).alias("residue"))


def _lis() -> Column:
    return F.coalesce(F.try_divide(F.sum("lis_sum"), F.sum("lis_n")), F.lit(0.0))


def lis(rows: DataFrame) -> DataFrame:
    """Directed local interaction score: mean of (12-pae)/12 up to 12, else 0."""
    return pae_blocks(rows).select(*PAIR, *_lis_sums()).groupBy(*PAIR).agg(_lis().alias("lis"))


def symmetric_mean(df: DataFrame, value: str) -> DataFrame:
    a, b = F.least("chain_i", "chain_j").alias("chain_a"), F.greatest("chain_i", "chain_j").alias("chain_b")
    return df.groupBy("structure_id", a, b).agg(F.avg(value).alias(value))


def _logistic(x: Column, consts: Sequence[float]) -> Column:
    top, slope, mid, base = consts
    return F.lit(top) / (F.lit(1.0) + F.exp(F.lit(-slope) * (x - mid))) + base


def all_pairs_of_chains(residues: DataFrame) -> DataFrame:
    chains = residues.select("structure_id", "chain").distinct()
    other = chains.withColumnRenamed("chain", "chain_j")
    return chains.withColumnRenamed("chain", "chain_i").join(other, "structure_id").filter("chain_i <> chain_j")


def docking_scores(own: DataFrame, residues: DataFrame) -> DataFrame:
    """Both docking scores per directed pair, 0 without contacts. ``own``: a row per touched
    residue (PAIR, i, n_near, kernel, n_kernel).

    Residue numbers may begin anew in each chain: every join carries the chain.
    Contacts come in both directions, so a pair's partner side is the own side of the
    reversed pair: one row per touched residue is enough for every figure.
    """
    conf = residues.select("structure_id", F.col("chain").alias("chain_i"), F.col("residue").alias("i"), "plddt")
    own = own.join(conf.hint("merge"), ["structure_id", "chain_i", "i"]).groupBy(*PAIR).agg(
        F.sum("n_near").alias("n_pairs"), F.try_divide(F.sum("kernel"), F.sum("n_kernel")).alias("mean_ptm"),
        F.sum("plddt").alias("p"), F.count("plddt").alias("np"),
    )
    both = Window.partitionBy("structure_id", F.least("chain_i", "chain_j"), F.greatest("chain_i", "chain_j"))
    own = own.withColumn("mean_plddt", F.sum("p").over(both) / F.sum("np").over(both))
    scored = own.select(
        *PAIR, "n_pairs", _logistic(F.col("mean_plddt") * F.log10("n_pairs"), PDOCKQ).alias("pdockq"),
        _logistic(F.col("mean_plddt") * F.col("mean_ptm"), PDOCKQ2).alias("pdockq2"),
    )
    out = all_pairs_of_chains(residues).join(scored, list(PAIR), "left")
    return out.na.fill({"n_pairs": 0, "pdockq": 0.0, "pdockq2": 0.0})


def contact_scores(contacts: DataFrame, residues: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Contact count, interface confidence and both docking scores per directed pair; the
    errors of the contacts are looked up in the matrix rows of their residues."""
    if rows is None:
        own = contacts.groupBy(*PAIR, "i").agg(F.count(F.lit(1)).alias("n_near"))
        own = own.withColumn("kernel", F.lit(None).cast("double")).withColumn("n_kernel", F.lit(0))
    else:
        found = F.filter(F.transform("near", lambda k: F.get("paes", k)), F.isnotnull)
        own = _near(pae_blocks(rows), contacts).filter(F.size("near") > 0).select(
            *PAIR, "i", F.size("near").alias("n_near"), F.size(found).alias("n_kernel"),
            _sum(found, lambda x: F.lit(1.0) / (F.lit(1.0) + (x / 10.0) * (x / 10.0))).alias("kernel"),
        )
    return docking_scores(own, residues)


def pdockq(contacts: DataFrame, residues: DataFrame) -> DataFrame:
    return contact_scores(contacts, residues).select(*PAIR, "n_pairs", "pdockq")


def pdockq2(contacts: DataFrame, rows: DataFrame, residues: DataFrame) -> DataFrame:
    return contact_scores(contacts, residues, rows).select(*PAIR, "pdockq2")


def interface_counts(rows: DataFrame, cutoff: float, contacts: DataFrame | None = None) -> DataFrame:
    """Valid pairs and distinct residues on each side, by error and optionally by distance."""
    blocks = pae_blocks(rows)
    flags = _below(cutoff)
    if contacts is not None:
        blocks = _near(blocks, contacts)
        flags = F.transform("paes", lambda x, k: F.coalesce(x < cutoff, F.lit(False)) & F.array_contains("near", k))
    return touched(blocks, flags).filter("pair_count > 0").select(
        *PAIR, "pair_count", F.col("touch_i").alias("nres1"), F.col("touch_j").cast("long").alias("nres2")
    )


def full_scores(rows: DataFrame, cutoff: float, contacts: DataFrame, residues: DataFrame) -> DataFrame:
    """Directed scores of all kinds from one evaluation of the residues' rows."""
    res = by_residue(rows, cutoff, contacts=contacts)
    docked = docking_scores(res.filter("n_near > 0").select(*PAIR, "i", "n_near", "kernel", "n_kernel"), residues)
    return asym_scores(res).join(docked, list(PAIR))


def pair_summary(asym: DataFrame) -> DataFrame:
    """One row per unordered pair: best of both directions, mean LIS, plain pDockQ."""
    a, b = F.least("chain_i", "chain_j").alias("chain_a"), F.greatest("chain_i", "chain_j").alias("chain_b")
    return asym.groupBy("structure_id", a, b).agg(
        F.max("ipsae").alias("ipsae"), F.max("ipsae_d0chn").alias("ipsae_d0chn"), F.max("ipsae_d0dom").alias("ipsae_d0dom"),
        F.max("iptm_d0chn").alias("iptm_d0chn"), F.max("pdockq2").alias("pdockq2"), F.avg("lis").alias("lis"),
        F.max("pdockq").alias("pdockq"),
    )


def scope_ipsae(asym: DataFrame, roles: DataFrame) -> DataFrame:
    """Binder-target value: the best pair of the directed scores, each pair counting with its
    better direction; also min and max of the directed scores. Every score is read once."""
    side = lambda n, r: roles.select("structure_id", F.col("chain").alias(n), F.col("role").alias(r))
    scoped = asym.select("structure_id", "chain_i", "chain_j", "ipsae").join(side("chain_i", "rx"), ["structure_id", "chain_i"])
    scoped = scoped.join(side("chain_j", "ry"), ["structure_id", "chain_j"]).filter(
        "(rx = 'binder' and ry = 'target') or (rx = 'target' and ry = 'binder')"
    )
    a, b = F.least("chain_i", "chain_j").alias("chain_a"), F.greatest("chain_i", "chain_j").alias("chain_b")
    pairs = scoped.groupBy("structure_id", a, b).agg(F.max("ipsae").alias("ipsae"), F.min("ipsae").alias("low"))
    return pairs.groupBy("structure_id").agg(
        F.max("ipsae").alias("value"), F.min_by(F.concat_ws("-", "chain_a", "chain_b"), F.struct(-F.col("ipsae"), F.col("chain_a"), F.col("chain_b"))).alias("best_pair"),
        F.count(F.lit(1)).alias("pairs"), F.min("low").alias("ipsae_min"), F.max("ipsae").alias("ipsae_max"),
    )


# -------------------------------------------------------- chain-pair matrices
MATRIX_KEYS = ("chain_pair_iptm", "chain_pair_ipTM", "chain_pair_interface_iptm")


def normalise_matrix(df: DataFrame, row_id: str, json_col: str, keys: Sequence[str] = MATRIX_KEYS) -> DataFrame:
    """Long (row, column, value) table from the first usable key; rows may be lists or
    objects with numeric names."""
    # Usable: a list of lists, or an object with a numeric name.
    def usable(key: str) -> Column:
        value = F.try_element_at("__doc", F.lit(key))
        return F.when(value.rlike(r"^\s*\[\s*(\[|\])") | value.rlike(r'^\s*\{(.*,)?\s*"\d+"\s*:'), F.struct(F.lit(key).alias("k"), value.alias("m")))

    docs = df.select(row_id, F.from_json(F.col(json_col), S.JSON_MAP).alias("__doc"))
    base = docs.select(row_id, F.coalesce(*[usable(k) for k in keys]).alias("u"))
    base = base.select(row_id, F.col("u.m").alias("m"), F.col("u.k").alias("source_key"))
    # Objects and lists both become (index, text) entries.
    def entries(c: Column) -> Column:
        listed = F.from_json(c, "array<string>")
        named = F.from_json(c, S.JSON_MAP)
        numbered = F.transform(listed, lambda v, k: F.struct(k.cast("int").alias("k"), v.alias("v")))
        keyed = F.transform(
            F.map_entries(named), lambda e: F.struct(e["key"].try_cast("int").alias("k"), e["value"].alias("v"))
        )
        return F.when(c.startswith("["), numbered).otherwise(keyed)

    rows = base.select(row_id, "source_key", F.explode(entries(F.col("m"))).alias("r"))
    cells = rows.select(row_id, "source_key", F.col("r.k").alias("i"), F.explode(entries(F.col("r.v"))).alias("c"))
    return cells.select(row_id, "source_key", "i", F.col("c.k").alias("j"), F.col("c.v").try_cast("double").alias("value")).filter(
        "i is not null and j is not null"
    )


def chain_pair_values(matrix: DataFrame, roles: DataFrame) -> DataFrame:
    """Directional values of every binder x target chain pair."""
    binder = roles.filter("role = 'binder'").select("structure_id", F.col("chain").alias("binder_chain"))
    target = roles.filter("role = 'target'").select("structure_id", F.col("chain").alias("target_chain"))
    pairs = binder.join(target, "structure_id")
    both = matrix.filter(F.abs("value") < float("inf"))  # finite: neither NULL, NaN nor infinite
    fwd = both.select("structure_id", F.col("chain_a").alias("binder_chain"), F.col("chain_b").alias("target_chain"), "value", F.lit("forward").alias("direction"))
    rev = both.select("structure_id", F.col("chain_b").alias("binder_chain"), F.col("chain_a").alias("target_chain"), "value", F.lit("reverse").alias("direction"))
    return fwd.unionByName(rev).join(pairs, ["structure_id", "binder_chain", "target_chain"])


def scoped_pair_metric(matrix: DataFrame, roles: DataFrame) -> DataFrame:
    """Pair value = smaller direction; overall value = smallest pair, with max and mean."""
    values = chain_pair_values(matrix, roles)
    pairs = values.groupBy("structure_id", "binder_chain", "target_chain").agg(F.min("value").alias("value"))
    return pairs.groupBy("structure_id").agg(
        F.min("value").alias("value"), F.max("value").alias("max_value"), F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("pairs")
    )


def binder_target_iptm(matrix: DataFrame, roles: DataFrame, complex_iptm: DataFrame) -> DataFrame:
    """Length-weighted and plain mean over target chains; falls back to the complex score."""
    per = chain_pair_values(matrix, roles).groupBy("structure_id", "target_chain").agg(F.avg("value").alias("v"))
    lengths = roles.select("structure_id", F.col("chain").alias("target_chain"), "length")
    agg = per.join(lengths, ["structure_id", "target_chain"]).groupBy("structure_id").agg(
        (F.sum(F.col("v") * F.col("length")) / F.sum("length")).alias("binder_target_iptm"),
        F.avg("v").alias("binder_target_iptm_unweighted"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("target_chain", "v")))).alias("by_chain"),
    )
    out = complex_iptm.join(agg, "structure_id", "left")
    return out.withColumn("iptm", F.coalesce("binder_target_iptm", "complex_iptm")).withColumn(
        "iptm_scope", F.when(F.col("binder_target_iptm").isNotNull(), "binder_target").when(F.col("complex_iptm").isNotNull(), "complex")
    )


def plddt_means(residues: DataFrame) -> DataFrame:
    """Means for complex, target and binder; 0..1 scales become 0..100."""
    p = F.when(~F.isnan("plddt") & (F.abs("plddt") < float("inf")), F.col("plddt"))
    agg = residues.groupBy("structure_id").agg(
        F.max(p).alias("top"), F.avg(p).alias("c"), F.avg(F.when(F.col("role") == "target", p)).alias("t"),
        F.avg(F.when(F.col("role") == "binder", p)).alias("b"),
    )
    scale = F.when(F.col("top") <= 1.5, 100.0).otherwise(1.0)
    return agg.select(
        "structure_id", (F.col("c") * scale).alias("plddt_complex"), (F.col("t") * scale).alias("plddt_target"),
        (F.col("b") * scale).alias("plddt_binder"),
    )
