"""Registers, chains, residue selections and index runs."""

from __future__ import annotations

import string
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindscope.operators.ranking import add_rank

CHAIN_ALPHABET = string.ascii_uppercase + string.ascii_lowercase + string.digits


def heavy_atoms(atoms: DataFrame, element: str = "element", name: str = "atom_name") -> DataFrame:
    hydrogen = F.upper(F.col(element)).isin("H", "D") | F.upper(F.col(name)).startswith("H")
    return atoms.filter(~F.coalesce(hydrogen, F.lit(False)))


# ----------------------------------------------------------------- selections
def _matches(residues: DataFrame, selectors: DataFrame, by: Sequence[str]) -> DataFrame:
    """Residues that a selector hits under either numbering (``auth``, ``label``), by one join
    on the structure keys; a range compares numbers only inside its own chain. The join is
    always shuffled: selectors that were made by an explode look small to the planner."""
    text = F.trim("selector")
    ranged = text.contains("-") & ~text.startswith("-")
    bounds = F.split(text, "-", 2)
    sel = selectors.select(
        *by, "selector_id", text.alias("__text"), ranged.alias("__ranged"),
        F.when(ranged, F.trim(F.get(bounds, F.lit(0))).try_cast("int")).alias("__lo"),
        F.when(ranged, F.trim(F.get(bounds, F.lit(1))).try_cast("int")).alias("__hi"),
    )
    res = residues.select(
        *by, "index", F.concat("auth_seq_id", F.coalesce("ins_code", F.lit(""))).alias("__auth"),
        F.col("auth_seq_id").try_cast("int").alias("__auth_n"), F.col("label_seq_id").alias("__label"),
        F.col("label_seq_id").try_cast("int").alias("__label_n"),
    )

    def hit(name: str) -> Column:
        inside = F.col(f"{name}_n").between(F.col("__lo"), F.col("__hi"))
        return F.coalesce(F.when(F.col("__ranged"), inside).when(~F.col("__ranged"), F.col(name) == F.col("__text")), F.lit(False))

    both = sel.hint("merge").join(res, [*by]).select(*by, "selector_id", "index", hit("__auth").alias("auth"), hit("__label").alias("label"))
    return both.filter("auth or label")


def select_residues(residues: DataFrame, selectors: DataFrame, indexing: str = "auto", by: Sequence[str] = ("structure_id", "chain")) -> DataFrame:
    """One row per selector and matched residue; ``status`` is ``ok``, ``ambiguous``
    (both numberings match different residues under ``auto``) or ``unmatched``.

    ``residues`` needs index, auth_seq_id, ins_code, label_seq_id; ``selectors`` needs
    selector_id and selector.
    """
    if indexing not in ("auto", "auth_seq_id", "label_seq_id"):
        raise ValueError("indexing must be auto, auth_seq_id or label_seq_id")
    hits = _matches(residues, selectors, by)
    if indexing != "auto":
        kept = indexing.split("_")[0]
        hits = hits.filter(kept).withColumn("label" if kept == "auth" else "auth", F.lit(False))
    keys = [*by, "selector_id"]
    sets = hits.groupBy(*keys).agg(
        F.array_sort(F.collect_set(F.when(F.col("auth"), F.col("index")))).alias("a"),
        F.array_sort(F.collect_set(F.when(F.col("label"), F.col("index")))).alias("l"),
    )
    both = (F.size("a") > 0) & (F.size("l") > 0) & (F.col("a") != F.col("l"))
    chosen = F.when(F.size("a") > 0, F.col("a")).otherwise(F.col("l"))
    verdict = selectors.select(*keys).hint("merge").join(sets.hint("merge"), keys, "left").select(
        *keys, F.when(F.col("a").isNull(), "unmatched").when(both, "ambiguous").otherwise("ok").alias("status"),
        F.when(F.col("a").isNotNull() & ~both, chosen).alias("indices"),
    )
    return verdict.select(*keys, "status", F.explode_outer("indices").alias("index"))


def require_selected(selected: DataFrame) -> DataFrame:
    """Fail on selectors that are ambiguous or match nothing."""
    text = F.concat(F.lit("selector "), F.col("selector_id").cast("string"), F.lit(": "), F.col("status"))
    checked = F.when(F.col("status") == "ok", F.col("index")).otherwise(F.raise_error(text).cast("bigint"))
    return selected.withColumn("index", checked)


def select_chains(chains: DataFrame, requested: DataFrame, by: Sequence[str] = ("structure_id",)) -> DataFrame:
    """Chain per request by canonical, author or label id, with the number of matches."""
    names = F.array_distinct(F.array("chain_id", "auth_asym_id", "label_asym_id"))
    held = chains.select(*by, "chain_id", F.explode(names).alias("requested"))
    hits = requested.join(held, [*by, "requested"], "left")
    agg = hits.groupBy(*by, "requested").agg(F.count("chain_id").alias("matches"), F.min("chain_id").alias("chain_id"))
    status = F.when(F.col("matches") == 1, "ok").when(F.col("matches") == 0, "unknown").otherwise("ambiguous")
    return agg.select(*by, "requested", status.alias("status"), F.when(F.col("matches") == 1, F.col("chain_id")).alias("chain_id"))


# -------------------------------------------------------------------- registers
def overlay_observed(register: DataFrame, observed: DataFrame, by: str = "structure_id") -> DataFrame:
    """Full register with observed residues laid over it: by label key, else author key.
    A different letter at a matched position is an error row (``status``)."""
    cols = ["auth_asym_id", "auth_seq_id", "ins_code", "letter", "x", "y", "z"]
    packed = F.struct(*cols)
    label = observed.filter("label_seq_id is not null and label_seq_id <> ''").groupBy(by, "label_asym_id", "label_seq_id").agg(
        F.max_by(packed, "position").alias("by_label")
    )
    auth = observed.filter("auth_seq_id is not null and auth_seq_id <> ''").groupBy(by, "auth_asym_id", "auth_seq_id", "ins_code").agg(
        F.max_by(packed, "position").alias("by_auth")
    )
    out = register.join(label, [by, "label_asym_id", "label_seq_id"], "left").join(
        auth, [by, "auth_asym_id", "auth_seq_id", "ins_code"], "left"
    )
    hit = F.coalesce("by_label", "by_auth")
    out = out.withColumn("o", hit)
    status = F.when(F.col("o").isNull(), "unresolved").when(F.col("o.letter") == F.col("letter"), "observed").otherwise("mismatch")
    return out.select(
        by, "label_asym_id", "label_seq_id", F.coalesce("o.auth_seq_id", "auth_seq_id").alias("auth_seq_id"), "letter",
        status.alias("status"), F.col("o.x").alias("x"), F.col("o.y").alias("y"), F.col("o.z").alias("z"),
    )


def require_overlay(overlay: DataFrame) -> DataFrame:
    text = F.concat(F.lit("observed residue does not match sequence metadata at "), "label_asym_id", F.lit(":"), "label_seq_id")
    return overlay.withColumn("status", F.when(F.col("status") != "mismatch", F.col("status")).otherwise(F.raise_error(text).cast("string")))


def embed_uniquely(observed: str, full: str) -> list[int] | None:
    """Positions of the only embedding of ``observed`` as a subsequence of ``full``.

    The leftmost and the rightmost embedding coincide exactly when there is one.
    """
    left, start = [], 0
    for ch in observed:
        at = full.find(ch, start)
        if at < 0:
            return None
        left.append(at)
        start = at + 1
    end = len(full)
    for k in range(len(observed) - 1, -1, -1):
        end = full.rfind(observed[k], 0, end)
        if end != left[k]:
            return None
    return left


def align_register(residues: DataFrame, by: Sequence[str]) -> DataFrame:
    """Position of each observed residue in the chain's full sequence, one chain per group.

    Author numbers are used as they are when all of them fit; else the embedding must be
    unique. ``status`` is ``direct``, ``aligned`` or ``ambiguous``. Needs ordinal,
    auth_seq_id, letter, full_sequence.
    """
    keys = list(by)

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ordinal")
        full = pdf["full_sequence"].iloc[0]
        numbers = pd.to_numeric(pdf["auth_seq_id"], errors="coerce")
        status = "direct"
        pos = None
        if numbers.notna().all():
            at = (numbers - 1).astype(int)
            fits = at.between(0, len(full) - 1).all() and at.is_unique
            if fits and all(full[p] == ch for p, ch in zip(at, pdf["letter"])):
                pos = at.tolist()
        if pos is None:
            pos, status = embed_uniquely("".join(pdf["letter"]), full), "aligned"
        out = pdf[[*keys, "ordinal"]].copy()
        out["position"] = pd.array(pos if pos is not None else [None] * len(pdf), dtype="Int64")
        out["status"] = status if pos is not None else "ambiguous"
        return out

    types = dict(residues.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in (*keys, "ordinal")) + ", position bigint, status string"
    return residues.select(*keys, "ordinal", "auth_seq_id", "letter", "full_sequence").groupBy(*keys).applyInPandas(place, schema)


def index_residues(atoms: DataFrame, by: Sequence[str], residue: Sequence[str], position: str = "position", carry: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """0-based residue index per chain in file order; the first atom wins on duplicates."""
    first = atoms.groupBy(*by, *residue, "atom_name").agg(F.min_by(F.struct(position, *carry), position).alias("a"))
    opened = Window.partitionBy(*by, *residue)
    ranked = first.withColumn("__start", F.min(f"a.{position}").over(opened))
    order = Window.partitionBy(*by).orderBy("__start")
    return ranked.select(
        *by, *residue, "atom_name", (F.dense_rank().over(order) - 1).cast("bigint").alias("residue_index"),
        *[F.col(f"a.{c}").alias(c) for c in carry],
    )


def canonical_chain_ids(chains: DataFrame, by: Sequence[str], source: str = "input_id", order: str = "chain_order") -> DataFrame:
    """Second and later repeats of an id get ``_2``, ``_3``; an empty id becomes ``chain``."""
    base = F.regexp_replace(F.coalesce(F.col(source), F.lit("")), "^$", "chain")
    w = Window.partitionBy(*by, "__base").orderBy(order)
    n = F.row_number().over(w)
    out = chains.withColumn("__base", base).withColumn("__n", n)
    name = F.when(F.col("__n") == 1, F.col("__base")).otherwise(F.concat_ws("_", "__base", F.col("__n").cast("string")))
    return out.withColumn("canonical_chain_id", name).drop("__base", "__n")


def chain_spans(chains: DataFrame, by: Sequence[str], order: str = "chain_order", length: str = "length") -> DataFrame:
    """Start and end offset of each chain in the concatenated residues."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(length).over(w), F.lit(0))
    return chains.withColumn("start", start.cast("bigint")).withColumn("end", (F.col("start") + F.col(length)).cast("bigint"))


def free_chain_id(chains: DataFrame, by: str, alphabet: str = CHAIN_ALPHABET) -> DataFrame:
    """First unused id of the 62-letter alphabet per structure."""
    used = F.array_distinct(F.collect_list("chain"))
    free = F.array_except(F.array(*[F.lit(ch) for ch in alphabet]), F.col("used"))
    # At most 62 single-letter ids can matter, so only those are gathered.
    held = chains.filter(F.col("chain").isin(*alphabet)).select(by, "chain").distinct()
    seen = held.groupBy(by).agg(used.alias("used"))
    ids = chains.select(by).distinct().join(seen, by, "left").withColumn("used", F.coalesce("used", F.array().cast("array<string>")))
    return ids.select(by, F.get(free, F.lit(0)).alias("free_chain"))


def assign_round_robin(designs: DataFrame, dim: DataFrame, index: str = "design_index", name: str = "canonical") -> DataFrame:
    """Framework ``index mod n`` for every design, for a panel of any size; null without a
    panel or an index.

    The panel is numbered by one exchange and joined on the slot. A small panel has few slots,
    which would pile the designs up in as many tasks, so each name is repeated until names and
    salts fill the partitions; whether the panel is broadcast is left to its size at run time.
    """
    parts = int(designs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = dim.select(name).filter(F.col(name).isNotNull()).distinct()
    total = names.agg(F.count(F.lit(1)).alias("n")).scalar()
    salts = F.greatest(F.lit(1), F.ceil(F.lit(parts) / F.nullif(total, F.lit(0).cast("bigint")))).cast("int")
    panel = add_rank(names, [F.col(name)], "__slot").select(
        (F.col("__slot") - 1).alias("__slot"), F.col(name).alias("framework"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("__salt")
    )
    asked = designs.withColumn("__slot", F.pmod(F.col(index).cast("bigint"), F.nullif(total, F.lit(0).cast("bigint"))))
    asked = asked.withColumn("__salt", F.pmod(F.hash(index), salts))
    return asked.join(panel, ["__slot", "__salt"], "left").drop("__slot", "__salt")


# ------------------------------------------------------------------------- runs
def index_runs(df: DataFrame, by: Sequence[str], index: str) -> DataFrame:
    """Half-open runs [start, end) of contiguous indices."""
    w = Window.partitionBy(*by).orderBy(index)
    held = df.select(*by, index).distinct().withColumn("__g", F.col(index) - F.row_number().over(w))
    runs = held.groupBy(*by, "__g").agg(F.min(index).alias("start"), (F.max(index) + 1).alias("end"))
    return runs.select(*by, F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))


def runs_text(runs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Runs as ``a-b+c`` with inclusive ends."""
    text = F.when(F.col("end") - F.col("start") == 1, F.col("start").cast("string")).otherwise(
        F.concat_ws("-", F.col("start").cast("string"), (F.col("end") - 1).cast("string"))
    )
    items = F.array_sort(F.collect_list(F.struct("start", text.alias("t"))))
    return runs.groupBy(*by).agg(F.array_join(F.transform(items, lambda x: x["t"]), "+").alias("runs"))


def mask_runs(mask: Column | str) -> Column:
    """Lengths of the runs of ``#`` in order."""
    return F.transform(F.regexp_extract_all(mask, F.lit("(#+)"), F.lit(1)), lambda r: F.length(r))


def mask_positions(sequence: Column | str, positions: Column | str) -> Column:
    """Replace the given 0-based positions by ``#``."""
    seq = F.col(sequence) if isinstance(sequence, str) else sequence
    pos = F.col(positions) if isinstance(positions, str) else positions
    chars = F.transform(F.split(seq, ""), lambda ch, i: F.when(F.array_contains(pos, i.cast("bigint")), "#").otherwise(ch))
    return F.array_join(chars, "")


# ------------------------------------------------------------------- report rows
# Columns of the residue audit table.
RESIDUE_MAP_FIELDS = (
    "canonical_chain_id", "model_residue_index_0", "sequence_1letter", "res_name", "input_chain", "input_residue",
    "input_insertion_code", "auth_asym_id", "auth_seq_id", "pdbx_PDB_ins_code", "label_asym_id", "label_seq_id",
    "is_observed", "sequence_source", "representative_atom", "resolved_representative_coord", "rep_x", "rep_y", "rep_z",
)


def residue_map(residues: DataFrame) -> DataFrame:
    """Audit table as text: missing values are empty, coordinates have three decimals."""
    from bindscope.functions.scalars import fixed_text, render_value

    held = {f.name: f.dataType for f in residues.schema.fields}
    resolved = F.col("rep_x").isNotNull()
    out = []
    for name in RESIDUE_MAP_FIELDS:
        if name.startswith("rep_"):
            value = F.coalesce(fixed_text(name, 3), F.lit(""))
        elif name == "resolved_representative_coord":
            value = resolved.cast("string")
        elif name in held:
            value = render_value(name, held[name])
        else:
            value = F.lit("")
        out.append(value.alias(name))
    return residues.select(*out)


def conditioning_summary(pairs: DataFrame) -> DataFrame:
    """Per structure and chain pair: index spans, pair count and resolved pair count."""
    return pairs.groupBy("structure_id", "chain_i", "chain_j").agg(
        F.min("i").alias("start_i"), (F.max("i") + 1).alias("end_i"), F.min("j").alias("start_j"), (F.max("j") + 1).alias("end_j"),
        F.count(F.lit(1)).alias("pair_count"), F.count_if("mask").alias("resolved_pairs"),
    )
