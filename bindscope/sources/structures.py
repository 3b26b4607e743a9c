"""Structure text files to long tables: one file per row, parsed where it is read."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindscope.functions import scalars as S
from bindscope.operators.structure import heavy_atoms


def read_files(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """(path, text) per file, from a folder of text files or from a packed Parquet table.

    Millions of small files cost more to list than to read; ``pack_files`` turns a folder
    into one table once.
    """
    if packed:
        return spark.read.schema("path string, text string").parquet(path)
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def pack_files(files: DataFrame, path: str) -> None:
    files.select("path", "text").write.mode("overwrite").parquet(path)


def pdb_lines(files: DataFrame) -> DataFrame:
    """Numbered lines of the first model."""
    first = F.substring_index(F.concat(F.lit("\n"), "text"), "\nENDMDL", 1)
    return files.select("path", F.posexplode(F.split(first, "\r?\n")).alias("position", "line"))


def pdb_atoms(files: DataFrame) -> DataFrame:
    """Fixed columns; standard residues only; the first alternate location per residue."""
    cut = lambda a, b: F.trim(F.substring("line", a, b - a + 1))
    atoms = pdb_lines(files).filter(F.col("line").startswith("ATOM  ")).select(
        "path", "position", cut(13, 16).alias("atom_name"), cut(17, 17).alias("alt"), F.upper(cut(18, 20)).alias("res_name"),
        F.regexp_replace(cut(22, 22), "^$", "_").alias("chain"), cut(23, 26).alias("auth_seq_id"), cut(27, 27).alias("ins_code"),
        cut(31, 38).try_cast("double").alias("x"), cut(39, 46).try_cast("double").alias("y"), cut(47, 54).try_cast("double").alias("z"),
        cut(61, 66).try_cast("double").alias("b_factor"), cut(77, 78).alias("element"),
    )
    known = atoms.filter(F.col("res_name").isin(*S.RESIDUE_LETTERS))
    residue = Window.partitionBy("path", "chain", "auth_seq_id", "ins_code", "res_name")
    first_alt = F.min(F.when(F.col("alt") != "", F.struct("position", "alt"))).over(residue)["alt"]
    kept = known.withColumn("__alt", first_alt).filter((F.col("alt") == "") | (F.col("alt") == F.col("__alt")))
    return kept.drop("alt", "__alt")


def read_pdb_atoms(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    return pdb_atoms(read_files(spark, path, packed))


def pdb_seqres(files: DataFrame) -> DataFrame:
    """Declared residues per chain in order."""
    rows = pdb_lines(files).filter(F.col("line").startswith("SEQRES")).select(
        "path", "position", F.regexp_replace(F.trim(F.substring("line", 12, 1)), "^$", "_").alias("chain"),
        F.posexplode(F.split(F.trim(F.substring("line", 20, 60)), r"\s+")).alias("k", "res_name"),
    )
    known = rows.withColumn("res_name", F.upper("res_name")).filter(F.col("res_name").isin(*S.RESIDUE_LETTERS))
    order = Window.partitionBy("path", "chain").orderBy("position", "k")
    return known.select("path", "chain", F.row_number().over(order).alias("number"), "res_name", S.residue_letter("res_name").alias("letter"))


_TOKEN = re.compile(r"'((?:[^']|'(?=\S))*)'(?=\s|$)|\"((?:[^\"]|\"(?=\S))*)\"(?=\s|$)|(\S+)")


def _tokens(line: str) -> list[str]:
    return [next(g for g in m.groups() if g is not None) for m in _TOKEN.finditer(line)]


def _loop_rows(text: str, category: str) -> Iterator[dict[str, str]]:
    """Rows of one category's loops: names in any order, quoted values, wrapped rows."""
    prefix = f"_{category}."
    fields: list[str] = []
    values: list[str] = []
    state = "outside"
    for raw in text.splitlines():
        line = raw.strip()
        if line == "loop_":
            fields, values, state = [], [], "header"
        elif state == "header" and line.startswith(prefix):
            fields.append(line.split()[0][len(prefix):])
        elif state == "header" and line.startswith("_"):
            state = "outside"
        elif state in ("header", "body") and fields:
            if not line or line.startswith(("#", "_", "data_")):
                state = "outside"
                continue
            state = "body"
            values.extend(_tokens(line))
            while len(values) >= len(fields):
                yield dict(zip(fields, values))
                values = values[len(fields):]


def cif_category(files: DataFrame, category: str, fields: Sequence[str]) -> DataFrame:
    """One category of many files as text columns; absent, ``.`` and ``?`` are NULL."""
    columns = list(fields)

    def tokenise_cif(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = list(_loop_rows(text, category))
                if rows:
                    values = [[None if r.get(c) in (None, ".", "?", "") else r[c] for r in rows] for c in columns]
                    arrays = [pa.array([path] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int64())]
                    arrays += [pa.array(v, pa.string()) for v in values]
                    yield pa.RecordBatch.from_arrays(arrays, ["path", "position", *columns])

    schema = "path string, position bigint, " + ", ".join(f"`{c}` string" for c in columns)
    return files.select("path", "text").mapInArrow(tokenise_cif, schema)


ATOM_FIELDS = (
    "group_PDB", "type_symbol", "label_atom_id", "auth_atom_id", "label_comp_id", "label_asym_id", "auth_asym_id",
    "label_seq_id", "auth_seq_id", "pdbx_PDB_ins_code", "Cartn_x", "Cartn_y", "Cartn_z",
)


def mmcif_atoms(files: DataFrame) -> DataFrame:
    """Heavy atoms: label ids before author ids; 0-based residue index from the number."""
    raw = cif_category(files, "atom_site", ATOM_FIELDS)
    name = F.coalesce("label_atom_id", "auth_atom_id")
    atoms = raw.select(
        "path", "position", F.coalesce("label_asym_id", "auth_asym_id").alias("chain"), name.alias("atom_name"),
        F.coalesce("type_symbol", F.substring(name, 1, 1)).alias("element"), F.col("label_comp_id").alias("res_name"),
        (F.coalesce("label_seq_id", "auth_seq_id").try_cast("bigint") - 1).alias("residue"),
        *[F.col(f"Cartn_{c}").try_cast("double").alias(c) for c in ("x", "y", "z")],
    )
    placed = atoms.filter("chain is not null and atom_name is not null and x is not null and y is not null and z is not null")
    return heavy_atoms(placed)


def read_mmcif_atoms(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    return mmcif_atoms(read_files(spark, path, packed))


SCHEME_FIELDS = ("asym_id", "entity_id", "seq_id", "mon_id", "auth_seq_num", "pdb_seq_num", "pdb_strand_id", "pdb_ins_code")


def polymer_scheme(files: DataFrame) -> DataFrame:
    """Full residue register of each chain from the polymer scheme."""
    raw = cif_category(files, "pdbx_poly_seq_scheme", SCHEME_FIELDS)
    name = F.upper("mon_id")
    known = raw.filter(F.col("asym_id").isNotNull() & name.isin(*S.RESIDUE_LETTERS))
    return known.select(
        "path", F.col("asym_id").alias("chain"), "entity_id", F.col("seq_id").try_cast("bigint").alias("number"), name.alias("res_name"),
        S.residue_letter("mon_id").alias("letter"), F.coalesce("auth_seq_num", "pdb_seq_num", "seq_id").alias("auth_seq_id"),
        F.coalesce("pdb_strand_id", "asym_id").alias("auth_asym_id"), F.coalesce("pdb_ins_code", F.lit("")).alias("ins_code"),
    )


def entity_residues(files: DataFrame) -> DataFrame:
    raw = cif_category(files, "entity_poly_seq", ("entity_id", "num", "mon_id"))
    known = raw.filter(F.col("entity_id").isNotNull() & F.upper("mon_id").isin(*S.RESIDUE_LETTERS))
    return known.select(
        "path", "entity_id", F.coalesce(F.col("num").try_cast("bigint"), F.col("position") + 1).alias("number"), F.upper("mon_id").alias("res_name")
    )


def read_polymer_register(spark: SparkSession, path: str, layout: str, packed: bool = False) -> DataFrame:
    """``layout``: ``scheme``, ``entity`` or ``seqres``."""
    reader = {"scheme": polymer_scheme, "entity": entity_residues, "seqres": pdb_seqres}[layout]
    return reader(read_files(spark, path, packed))
