"""Confidence documents of several models, read into matrix rows, residue confidences and
chain-pair scores.

Documents are parsed as VARIANT, so the layout may differ from row to row: what a document
holds is told from its own keys. Text that is no JSON object gives no rows. Positions in a
document are ordinals (of tokens, or of atoms); a map of tokens or atoms, joined by
ordinal, names their chain and residue, and leaves out those that are no residue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key names per layout.
LAYOUTS = {
    "af2": {"pae": ("pae", "predicted_aligned_error"), "plddt": ("plddt",)},
    "af3": {"pae": ("pae", "token_pair_pae"), "plddt": ("atom_plddts", "atom_plddt")},
    "boltz": {"pae": ("pae",), "plddt": ("plddt",)},
}
PAE_KEYS = ("pae", "predicted_aligned_error", "token_pair_pae")
ATOM_KEYS, RESIDUE_KEYS = ("atom_plddts", "atom_plddt"), ("plddt",)
LIST_PAIRS, NAMED_PAIRS = ("chain_pair_iptm",), ("pair_chains_iptm",)


def _first(keys: tuple[str, ...], kind: str) -> Column:
    return F.coalesce(*[F.try_variant_get("__v", f"$.{k}", kind) for k in keys])


def read_documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: ``layout``, ``pae``, ``atom_plddt`` or ``token_plddt`` as 0..100,
    ``pairs`` (chain ordinals and ipTM), ``iptm`` and ``ptm``; null where a document has none."""
    docs = df.select(id_col, F.try_parse_json(text_col).alias("__v"))
    listed = _first(LIST_PAIRS, "array<array<double>>")
    named = _first(NAMED_PAIRS, "map<string,map<string,double>>")
    cell = lambda i, j, v: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), v.alias("value"))
    from_lists = F.flatten(F.transform(listed, lambda row, i: F.transform(row, lambda v, j: cell(i, j, v))))
    from_names = F.flatten(F.transform(F.map_entries(named), lambda r: F.transform(
        F.map_entries(r["value"]), lambda e: cell(r["key"].try_cast("int"), e["key"].try_cast("int"), e["value"])
    )))
    atom, token = _first(ATOM_KEYS, "array<double>"), _first(RESIDUE_KEYS, "array<double>")
    out = docs.select(
        id_col, _first(PAE_KEYS, "array<array<double>>").alias("pae"), atom.alias("atom_plddt"), token.alias("token_plddt"),
        F.coalesce(from_lists, from_names).alias("pairs"), _first(("iptm",), "double").alias("iptm"), _first(("ptm",), "double").alias("ptm"),
        F.when(F.coalesce(atom.isNotNull() | listed.isNotNull(), F.lit(False)), "af3").when(named.isNotNull(), "boltz")
        .when(token.isNotNull() | _first(PAE_KEYS, "variant").isNotNull(), "af2").alias("layout"),
    )
    hundred = lambda c: F.when(F.array_max(c) <= 1.5, F.transform(c, lambda p: p * 100.0)).otherwise(F.col(c))
    return out.withColumn("atom_plddt", hundred("atom_plddt")).withColumn("token_plddt", hundred("token_plddt"))


def matrix_rows(docs: DataFrame, tokens: DataFrame, id_col: str) -> DataFrame:
    """Rows of the error matrix as the interface scores take them: ``structure_id``, ``chain``,
    ``i``, ``errors`` towards all residues by chain and number, ``spans``. ``tokens``: id_col,
    token, chain, residue for every token that is a residue; a chain's residues are numbered
    without gaps."""
    one = F.struct("chain", "residue", "token")
    kept = tokens.groupBy(id_col).agg(F.array_sort(F.collect_list(one)).alias("kept"))
    ends = tokens.groupBy(id_col, "chain").agg(F.count(F.lit(1)).cast("int").alias("n"), F.min("residue").cast("bigint").alias("first"))
    ends = ends.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("chain", "n", "first"))).alias("c"))
    spans = F.transform("c", lambda e, k: F.struct(
        e["chain"].alias("chain"), F.aggregate(F.slice("c", F.lit(1), k), F.lit(0), lambda acc, x: acc + x["n"]).alias("start"),
        e["n"].alias("length"), e["first"].alias("first"), e["n"].alias("residues"),
    ))
    maps = kept.join(ends.select(id_col, spans.alias("spans")), id_col)
    rows = docs.select(id_col, "pae").join(maps, id_col).select(id_col, "pae", "kept", "spans", F.explode("kept").alias("own"))
    row = F.get("pae", F.col("own.token").cast("int"))
    return rows.select(
        F.col(id_col).alias("structure_id"), F.col("own.chain").alias("chain"), F.col("own.residue").cast("bigint").alias("i"),
        F.transform("kept", lambda k: F.get(row, k["token"].cast("int"))).alias("errors"), "spans",
    ).filter("exists(errors, e -> e is not null)")


def residue_plddt(docs: DataFrame, tokens: DataFrame, atoms: DataFrame, id_col: str, atom_name: str = "CA") -> DataFrame:
    """(id_col, chain, residue, plddt): of a document with a value per atom, that of the residue's
    ``atom_name``; else the token's. ``atoms``: id_col, ordinal, chain, residue, atom_name."""
    by_atom = docs.select(id_col, F.posexplode("atom_plddt").alias("ordinal", "plddt"))
    chosen = atoms.filter(F.col("atom_name") == atom_name).select(id_col, "ordinal", "chain", "residue")
    by_token = docs.filter("atom_plddt is null").select(id_col, F.posexplode("token_plddt").alias("token", "plddt"))
    out = by_atom.join(chosen, [id_col, "ordinal"]).drop("ordinal").unionByName(
        by_token.join(tokens.select(id_col, "token", "chain", "residue"), [id_col, "token"]).drop("token")
    )
    return out.select(id_col, "chain", "residue", "plddt")


def chain_pair_iptm(docs: DataFrame, chains: DataFrame, id_col: str) -> DataFrame:
    """(structure_id, chain_a, chain_b, value) of every pair of different chains; ``chains``:
    id_col, ordinal, chain."""
    cells = docs.select(id_col, F.inline("pairs")).filter("i <> j")
    side = lambda n, c: chains.select(id_col, F.col("ordinal").alias(n), F.col("chain").alias(c))
    out = cells.join(side("i", "chain_a"), [id_col, "i"]).join(side("j", "chain_b"), [id_col, "j"])
    return out.select(F.col(id_col).alias("structure_id"), "chain_a", "chain_b", "value")


def _schema(layout: str) -> str:
    keys = LAYOUTS[layout]
    fields = [f"`{k}`: array<array<double>>" for k in keys["pae"]] + [f"`{k}`: array<double>" for k in keys["plddt"]]
    return "struct<" + ", ".join(fields) + ">"


def parse_confidence(df: DataFrame, id_col: str, text_col: str, layout: str) -> tuple[DataFrame, DataFrame]:
    """(pae, plddt) long tables of documents of one known layout. Only the layout's own keys are
    parsed; a 0..1 confidence scale becomes 0..100."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of: {', '.join(LAYOUTS)}")
    keys = LAYOUTS[layout]
    docs = df.select(id_col, F.from_json(text_col, _schema(layout)).alias("d"))
    matrix = F.coalesce(*[F.col(f"d.{k}") for k in keys["pae"]])
    rows = docs.select(id_col, F.posexplode(matrix).alias("i", "row"))
    pae = rows.select(id_col, F.col("i").cast("bigint").alias("i"), F.posexplode("row").alias("j", "pae"))
    pae = pae.withColumn("j", F.col("j").cast("bigint"))
    values = F.coalesce(*[F.col(f"d.{k}") for k in keys["plddt"]])
    scaled = docs.select(id_col, values.alias("v")).withColumn("s", F.when(F.array_max("v") <= 1.5, 100.0).otherwise(1.0))
    plddt = scaled.select(id_col, "s", F.posexplode("v").alias("residue", "p")).select(
        id_col, F.col("residue").cast("bigint").alias("residue"), (F.col("p") * F.col("s")).alias("plddt")
    )
    return pae, plddt
