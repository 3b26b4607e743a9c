"""FASTA-like records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindscope.functions.scalars import normalize_sequence


def read_fasta(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, ordinal, header, sequence): NULs removed, wrapped lines joined, lines trimmed.

    Text is cut at header lines inside the row, so no line is shuffled. A repeated header
    keeps its first place and takes the last sequence.
    """
    clean = F.regexp_replace(F.regexp_replace(F.col(text_col), "\u0000", ""), r"\r\n?|[\x0B\x0C\x1C-\x1E\x85  ]", "\n")
    parts = F.split(F.concat(F.lit("\n"), clean), r"\n[^\S\n]*>")
    # The first part precedes any header.
    records = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    rows = df.select(id_col, F.posexplode(records).alias("ordinal", "r"))
    header = F.trim(F.regexp_extract("r", r"^([^\n]*)", 1))
    body = F.regexp_replace(F.regexp_extract("r", r"(?s)^[^\n]*\n(.*)$", 1), r"[^\S\n]*\n[^\S\n]*", "")
    named = rows.select(id_col, "ordinal", header.alias("header"), F.trim(body).alias("sequence")).filter("header <> ''")
    return named.groupBy(id_col, "header").agg(F.min("ordinal").alias("ordinal"), F.max_by("sequence", "ordinal").alias("sequence"))


def wrap(c: Column | str, width: int = 80) -> Column:
    if width <= 0:
        raise ValueError("width must be positive")
    return F.regexp_replace(c, f"(.{{{width}}})(?=.)", "$1\n")


def to_fasta_lines(df: DataFrame, id_col: str, seq_col: str, width: int = 80) -> DataFrame:
    """One text record per row; bad identifiers and sequences are errors."""
    ident, seq = F.trim(F.col(id_col).cast("string")), normalize_sequence(seq_col)
    good = (ident != "") & ~ident.rlike(r"\s") & ~ident.startswith(">") & (seq != "") & ~seq.contains(">")
    record = F.concat(F.lit(">"), ident, F.lit("\n"), wrap(seq, width))
    failure = F.raise_error(F.concat(F.lit("not a FASTA record: "), F.coalesce(ident, F.lit("NULL")))).cast("string")
    return df.select(F.when(good, record).otherwise(failure).alias("value"))
