"""Scalar expressions: identifiers, lenient casts, JSON lookups, text rendering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Residue names and their one-letter codes.
RESIDUE_LETTERS = {
    "ALA": "A", "ARG": "R", "ASN": "N", "ASP": "D", "CYS": "C",
    "GLN": "Q", "GLU": "E", "GLY": "G", "HIS": "H", "ILE": "I",
    "LEU": "L", "LYS": "K", "MET": "M", "PHE": "F", "PRO": "P",
    "SER": "S", "THR": "T", "TRP": "W", "TYR": "Y", "VAL": "V",
}

JSON_MAP = "map<string,string>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is evaluated exactly once per row.

    A plain projection is copied into every later filter that mentions it, so a parsed
    document would be parsed once per mention. A one-element generator is not.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


# ---------------------------------------------------------------- identifiers
# Each helper names its argument once: a repeated argument is evaluated again, and
# nesting such helpers multiplies the expression tree.
def nonblank(*cols: Column | str) -> Column:
    """First text that is neither NULL nor empty."""
    held = F.filter(F.array(*[_col(c).cast("string") for c in cols]), lambda v: v != "")
    return F.get(held, F.lit(0))


def or_else(c: Column, fallback: str) -> Column:
    """``fallback`` for NULL and empty text."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), "^$", fallback)


def slug(c: Column | str, fallback: str) -> Column:
    """Runs of non-alphanumerics become ``_``; trimmed, lower-cased, with a fallback."""
    text = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "_")
    return or_else(F.trim(text, F.lit("_")), fallback)


def safe_token(c: Column | str, fallback: str = "artifact") -> Column:
    text = F.regexp_replace(F.trim(_col(c)), "[^A-Za-z0-9._-]+", "_")
    return or_else(F.trim(text, F.lit("._-")), fallback)


def safe_identifier(c: Column | str, max_len: int, fallback: str = "candidate") -> Column:
    text = F.trim(F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "_"), F.lit("_"))
    cut = F.trim(F.substring(or_else(text, fallback), 1, max_len), F.lit("_"))
    return or_else(cut, fallback)


def zero_pad(c: Column | str, width: int | Column) -> Column:
    """Left-pad with zeros; longer numbers are kept whole."""
    text = _col(c).cast("string")
    width = F.lit(width) if isinstance(width, int) else width
    return F.when(F.length(text) >= width, text).otherwise(
        F.concat(F.repeat(F.lit("0"), width - F.length(text)), text)
    )


def padded_id(prefix: str, cols: Sequence[Column | str], widths: Sequence[int | Column]) -> Column:
    parts = [zero_pad(c, w) for c, w in zip(cols, widths, strict=True)]
    return F.concat_ws("_", F.lit(prefix), *parts)


def artifact_stem(batch: Column, seed: Column, candidate: Column, widths: Sequence[Column | int]) -> Column:
    return F.concat(
        F.lit("s"), zero_pad(batch, widths[0]),
        F.lit("_seed"), zero_pad(seed, widths[1]),
        F.lit("_c"), zero_pad(candidate, widths[2]),
    )


def binder_code(c: Column | str) -> Column:
    value = F.regexp_replace(slug(c, "binder"), "^(miniprotein|minibinder|mini_binder)$", "mp")
    return F.regexp_replace(value, "^sc_fv$", "scfv")


def semantic_id(target: Column | str, scaffold: Column | str, seed: Column | str, k: Column | str) -> Column:
    base = F.concat_ws(
        "_", slug(target, "target"), binder_code(scaffold), F.concat(F.lit("seed"), _col(seed).cast("string"))
    )
    suffix = F.when(_col(k) > 0, F.concat(F.lit("_c"), _col(k).cast("string"))).otherwise("")
    return F.concat(base, suffix)


def short_sha(c: Column, n: int) -> Column:
    return F.substring(F.sha2(c, 256), 1, n)


def task_id(candidate: Column | str, model: Column | str, config_hash: Column | str) -> Column:
    digest = short_sha(F.concat_ws("|", _col(candidate), _col(model), _col(config_hash)), 10)
    return F.concat_ws("_", F.lit("val"), safe_identifier(candidate, 80), digest)


def job_id(scope: Column | str, key: Column | str, context: Column | str) -> Column:
    digest = short_sha(F.concat_ws("|", _col(scope), _col(key), _col(context)), 16)
    return F.concat_ws("_", F.lit("msa"), safe_identifier(scope, 32), digest)


def canonical_json(fields: dict[str, Column], spaced: bool = False) -> Column:
    """Sorted-key JSON text of string/number columns; ``spaced`` uses ``", "`` and ``": "``."""
    comma, colon = (", ", ": ") if spaced else (",", ":")
    parts = []
    for name in sorted(fields):
        # to_json drops nulls, so the value is cut out of a one-field object.
        value = F.regexp_extract(F.to_json(F.struct(fields[name].alias("v"))), r'^\{"v":(.*)\}$', 1)
        value = F.when(fields[name].isNull(), "null").otherwise(value)
        parts.append(F.concat(F.lit(f'"{name}"{colon}'), value))
    return F.concat(F.lit("{"), F.concat_ws(comma, *parts), F.lit("}"))


def canonical_hash(fields: dict[str, Column], spaced: bool = False, n: int = 64) -> Column:
    return short_sha(canonical_json(fields, spaced), n)


# ------------------------------------------------------------------ sequences
def normalize_sequence(c: Column | str) -> Column:
    return F.upper(F.regexp_replace(_col(c), r"\s+", ""))


def alpha_sequence(c: Column | str) -> Column:
    """Letters only, upper-cased: the form used to compare chain sequences."""
    return F.regexp_replace(F.upper(F.coalesce(_col(c), F.lit(""))), r"[^\p{L}]", "")


def is_protein(c: Column | str) -> Column:
    return _col(c).rlike("^[ACDEFGHIKLMNPQRSTVWYX]+$")


def residue_letter(c: Column | str) -> Column:
    pairs = [F.lit(x) for kv in RESIDUE_LETTERS.items() for x in kv]
    name = F.upper(F.trim(_col(c)))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), F.lit("X"))


def chain_index(c: Column | str) -> Column:
    """A..Z (either case) to 0..25; anything else is -1."""
    text = F.upper(_col(c))
    return F.when(text.rlike("^[A-Z]$"), F.ascii(text) - 65).otherwise(-1).cast("int")


def chain_letter(c: Column | str) -> Column:
    i = _col(c)
    return F.when(i.between(0, 25), F.char(i.cast("bigint") + 65))


# ------------------------------------------------------------- lenient values
def opt_float(c: Column | str) -> Column:
    value = _col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def opt_int(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def opt_bool(c: Column | str, dtype: T.DataType | str = "string") -> Column:
    """Text true/1/yes and false/0/no; native booleans pass; other types give NULL."""
    kind = dtype if isinstance(dtype, str) else dtype.simpleString()
    if kind == "boolean":
        return _col(c)
    if kind != "string":
        return F.lit(None).cast("boolean")
    text = F.lower(F.trim(_col(c)))
    return F.when(text.isin("true", "1", "yes"), True).when(text.isin("false", "0", "no"), False)


def hotspot_flag(c: Column | str) -> Column:
    """Numbers count when positive; any other non-empty text counts."""
    x = _col(c).cast("string")
    return F.when(x.isNull() | (x == ""), F.lit(None).cast("boolean")).otherwise(
        F.coalesce(x.try_cast("double") > 0, F.lit(True))
    )


def first_nonempty(*cols: Column | str) -> Column:
    return nonblank(*cols)


def first_present(doc1: Column | str, doc2: Column | str | None, keys: Sequence[str]) -> Column:
    """First key that exists, even with a null value, in document 1 and then 2."""
    out: Column | None = None
    for doc in (doc1, doc2):
        if doc is None:
            continue
        for key in keys:
            held = F.coalesce(F.map_contains_key(_col(doc), key), F.lit(False))
            value = F.try_element_at(_col(doc), F.lit(key))
            out = F.when(held, value) if out is None else out.when(held, value)
    assert out is not None
    return out


def decode_metrics(c: Column | str, row_id: Column | str, lenient: bool = False) -> Column:
    """JSON object text to map; strict decoding fails naming the row."""
    text = _col(c)
    if lenient:
        return F.coalesce(F.from_json(text, JSON_MAP), F.create_map().cast(JSON_MAP))
    parsed = F.from_json(or_else(text, "{}"), JSON_MAP)
    failure = F.raise_error(F.concat(F.lit("invalid metrics JSON for "), _col(row_id))).cast(JSON_MAP)
    return F.coalesce(parsed, failure)


def decode_list(c: Column | str) -> Column:
    """JSON array text to strings without empty items; bad text gives an empty list."""
    parsed = F.from_json(_col(c), "array<string>")
    return F.filter(F.coalesce(parsed, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))


def unique_texts(c: Column | str) -> Column:
    kept = F.filter(_col(c), lambda x: x.isNotNull() & (F.trim(x) != ""))
    return F.array_distinct(kept)


def merge_metadata(a: Column | str, b: Column | str, prefer: str) -> Column:
    """Union of two maps; ``prefer`` says whose value wins on a shared key."""
    if prefer == "first":
        return F.map_zip_with(_col(a), _col(b), lambda k, x, y: F.coalesce(x, y))
    return F.map_zip_with(_col(a), _col(b), lambda k, x, y: F.coalesce(y, x))


# ------------------------------------------------------------------ rendering
def _formatted(x: Column, places: int, pattern: str, strip: bool) -> Column:
    """Number text, rounded half to even from the exact binary value.

    ``format_string`` would round the shortest decimal text half up instead. The pattern
    formatter is exact but for one number, half a unit of the last place, which is
    written out here.
    """
    half = 5.0 * 10.0 ** -(places + 1)
    text = f"{half:.{places}f}"
    text = text.rstrip("0").rstrip(".") if strip else text
    tiny = F.when(x < 0, f"-{text}").otherwise(text)
    return F.when(F.abs(x) == half, tiny).otherwise(F.call_function("format_number", x, F.lit(pattern)))


def fixed_text(c: Column | str, places: int) -> Column:
    """Exactly ``places`` decimals."""
    return _formatted(_col(c).cast("double"), places, "0." + "0" * places if places else "0", False)


def render_number(c: Column | str) -> Column:
    """At most three decimals without trailing zeros; non-finite becomes empty."""
    x = _col(c).cast("double")
    return F.when(F.abs(x) < F.lit(float("inf")), _formatted(x, 3, "0.###", True)).otherwise("")


def repair_quoted_number(c: Column | str) -> Column:
    text = F.trim(_col(c))
    inner = F.substring(text, F.lit(2), F.length(text))
    number = F.when(text.startswith("'"), inner.try_cast("double"))
    return F.when(number.isNotNull(), render_number(number)).otherwise(_col(c))


def render_value(c: Column | str, dtype: T.DataType) -> Column:
    c = _col(c)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(F.when(c, "true").otherwise(F.when(c.isNotNull(), "false")), F.lit(""))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return render_number(c)
    if isinstance(dtype, T.StringType):
        return F.coalesce(repair_quoted_number(c), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def parse_utc(c: Column | str) -> Column:
    return F.to_timestamp(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSX")


def format_utc(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def stale_seconds(heartbeat: float) -> float:
    return max(90.0, 3.0 * heartbeat)


def stale_cutoff(now: Column, heartbeat: float) -> Column:
    return now - F.make_dt_interval(secs=F.lit(stale_seconds(heartbeat)))


# ------------------------------------------------------------------ numbers
def d0(length: Column, nucleic: Column | bool = False) -> Column:
    """Length-dependent distance scale with a floor of 1 (2 with nucleic acids)."""
    floor = F.when(F.lit(nucleic) if isinstance(nucleic, bool) else nucleic, 2.0).otherwise(1.0)
    eff = F.greatest(length.cast("double"), F.lit(27.0))
    return F.greatest(floor, F.lit(1.24) * F.pow(eff - 15.0, F.lit(1.0 / 3.0)) - 1.8)


def ptm_kernel(pae: Column, scale: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.pow(pae / scale, F.lit(2.0)))


def bin_midpoints() -> Column:
    """128 bin centres: 127 boundaries from 2 to 52, closed by 1 and 57."""
    inner = lambda k: F.lit(2.0) + F.lit(50.0 / 126.0) * (k - F.lit(0.5))
    return F.transform(F.sequence(F.lit(0), F.lit(127)), lambda k: F.when(k == 0, 1.5).when(k == 127, 54.5).otherwise(inner(k)))


def distance_bin(c: Column | str) -> Column:
    """64 bins of 0.3125 over 2..22; a boundary belongs to the bin below it."""
    raw = F.ceil((_col(c) - 2.0) / 0.3125) - 1
    return F.greatest(F.lit(0), F.least(F.lit(63), raw)).cast("int")
