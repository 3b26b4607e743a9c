"""Secret scans in DataFrame functions only; one pass, no shuffle.

Three fixed kinds (``assign``, ``access``, ``hex``) by pattern, and ``entropy``: strings of
at least ``WINDOW`` token characters in which some window of ``WINDOW`` characters has a
Shannon entropy of at least the limit of the string's character class. The sum of
c*log2(c) over a window's character counts is carried from window to window: leaving and
entering characters change it by one term each. Strings on the allow-list add nothing. Of a
string that overlaps spans of fixed kinds, each part outside them is tested as a string of
its own; parts of fewer than ``WINDOW`` characters have no window.

A span is (start, end) in code points, end exclusive; that of ``assign`` covers the whole
match, keyword included. Nulls and odd rows: a null or empty text has no spans; repeated
rows each return a row; a row without id keeps its null id; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 20
#: Kinds in the order in which they are listed.
KINDS = ["assign", "access", "hex", "entropy"]
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Bits for each character class: hexadecimal digits, letters and digits, token characters.
LIMITS = {"hex": 3.0, "alnum": 3.75, "token": 3.85}
C, V = "b-df-hj-np-tv-xz", "B-DF-HJ-NP-TV-XZ"  # consonants, of either case
#: What letters and separators have if they are not words: more than 18 letters of one case
#: on end, case that changes inside a word, a capitalised word of consonants beside another,
#: six consonants on end, two neighbouring words of consonants.
NOT_WORDS = "|".join([
    "[a-z]{19}", "[A-Z]{19}", "[A-Z]{2}[a-z]", "[a-z][A-Z](?![a-z])", f"[a-z][{V}][{C}]+(?![a-z])", f"[{V}][{C}]+[A-Z]",
    f"[{C}{V}]{{6}}", f"(?<![A-Za-z])[{C}{V}]+[/=_-]+[{C}{V}]+(?![A-Za-z])",
])
#: Allowed: UUIDs, words joined by separators, paths of words, runs of one character, ISO dates.
ALLOWED = [
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    rf"^(?!.*(?:{NOT_WORDS}))[A-Za-z/=_-]+$",
    r"^(.)\1+$",
    r"^[0-9/_=-]+$",
]


def found(text: Column, pattern: str, guard: Column, group: int = 0) -> Column:
    """Matches as (start, end, value, part), leftmost first. The pieces between the matches
    give their places."""
    piece, value = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    empty = F.array().cast("array<struct<start:int,end:int,value:string,part:string>>")
    zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def add(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["gap"])
        end = start + F.length(m["value"])
        span = F.struct(start.alias("start"), end.alias("end"), m["value"].alias("value"), m["part"].alias("part"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    count = F.size(value)
    rows = F.arrays_zip(F.slice(piece, 1, count).alias("gap"), value.alias("value"), part.alias("part"))
    return F.when(guard, F.aggregate(rows, zero, add, lambda acc: acc["out"])).otherwise(empty)


def least_sum(chars: Column) -> Column:
    """The least sum of c*log2(c) over all windows of the character array."""
    term = F.array(*[F.lit(k * math.log2(k) if k else 0.0) for k in range(WINDOW + 1)])

    def step(acc: Column, i: Column) -> Column:
        # ``kept``: the characters that the windows ending at i-1 and at i have in common.
        kept = F.slice(chars, F.greatest(F.lit(1), i - WINDOW + 1), F.least(i - 1, F.lit(WINDOW - 1)))
        entering = F.get(chars, i - 1)
        leaving = F.get(chars, i - 1 - WINDOW)
        a = F.size(F.filter(kept, lambda x: x == entering))
        b = F.size(F.filter(kept, lambda x: x == leaving))
        drop = F.when(i > WINDOW, F.get(term, b + 1) - F.get(term, b)).otherwise(0.0)
        s = acc["s"] - drop + F.get(term, a + 1) - F.get(term, a)
        return F.struct(s.alias("s"), F.when(i >= WINDOW, F.least(acc["best"], s)).otherwise(acc["best"]).alias("best"))

    zero = F.struct(F.lit(0.0).alias("s"), F.lit(1e9).alias("best"))
    return F.aggregate(F.sequence(F.lit(1), F.size(chars)), zero, step, lambda acc: acc["best"])


def entropy(value: Column) -> Column:
    """The greatest entropy of a window, in bits, of a string of WINDOW characters or more."""
    return F.lit(math.log2(WINDOW)) - least_sum(F.split(value, "")) / WINDOW


def is_secret(value: Column) -> Column:
    limit = (
        F.when(value.rlike("^[0-9a-fA-F]+$"), LIMITS["hex"]).when(value.rlike("^[A-Za-z0-9]+$"), LIMITS["alnum"]).otherwise(LIMITS["token"])
    )
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | value.rlike(pattern)
    # An entropy within 1e-9 of the limit counts as the limit: sums differ in their last bits.
    return F.when(allowed, False).otherwise(F.round(entropy(value), 9) >= limit)


def outside(m: Column, base: Column) -> Column:
    """The parts of ``m`` of WINDOW characters or more that no span of ``base`` covers."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def part(start: Column, end: Column) -> Column:
        value = F.substring(m["value"], start - m["start"] + 1, end - start)
        one = F.array(F.struct(start.alias("start"), end.alias("end"), value.alias("value")))
        return F.when(end - start >= WINDOW, one).otherwise(none)

    def add(acc: Column, s: Column) -> Column:
        found = F.concat(acc["out"], part(acc["at"], s["start"]))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), found.alias("out"))

    met = F.array_sort(F.filter(base, lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"])))
    zero = F.struct(m["start"].alias("at"), none.alias("out"))
    return F.aggregate(met, zero, add, lambda acc: F.concat(acc["out"], part(acc["at"], m["end"])))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the spans of each kind as (start, end) arrays."""
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    rows = rows.select(
        "doc_id", "text",
        F.filter(found(text, ASSIGN, text.rlike(ASSIGN), 2), lambda m: F.length(m["part"]) >= 6).alias("assign"),
        found(text, ACCESS, F.contains(text, F.lit("AKIA"))).alias("access"),
        found(text, HEX, text.rlike(HEX)).alias("hex"),
        found(text, CANDIDATE, text.rlike(CANDIDATE)).alias("candidates"),
    )
    base = F.concat("assign", "access", "hex")
    parts = F.flatten(F.transform("candidates", lambda m: outside(m, base)))
    return rows.select(
        "doc_id", "text", "assign", "access", "hex",
        F.filter(parts, lambda m: is_secret(m["value"])).alias("entropy"),
    )


def listed(kinds: list[str]) -> Column:
    """kind:start:end of all spans, by start, then kind as listed."""
    def numbered(kind: int) -> Column:
        return F.transform(kinds[kind], lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))

    parts = [numbered(k) for k in range(len(kinds))]
    name = F.array(*[F.lit(k) for k in KINDS])
    joined = F.transform(F.array_sort(F.concat(*parts)), lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"]))
    return F.concat_ws(",", joined)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the fixed kinds, base_sha256, spans, n_entropy."""
    return scan(docs).select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(KINDS[:3]), 256).alias("base_sha256"),
        listed(KINDS).alias("spans"),
        F.size("entropy").cast("long").alias("n_entropy"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark`` (spans that overlap by one
    mark) and n_chars set anew where the text changed. All other values stay."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.withColumn("__row", F.struct(*[F.col(c) for c in docs.columns]))
    spans = scan(named.select(F.col("__row").alias("doc_id"), text.alias("text")))
    spans = spans.select(F.col("doc_id").alias("row"), "text", F.array_sort(F.concat(*[
        F.transform(k, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))) for k in KINDS
    ])).alias("spans"))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.concat(acc["out"], gap, F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when((s["start"] >= acc["at"]) & (s["end"] > 0), fresh).otherwise(acc["out"]).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    new = F.when(F.size("spans") > 0, F.aggregate("spans", zero, add, rest)).otherwise(F.col("row.text"))
    out = spans.select("row", "spans", new.alias("new"))
    values = {"text": F.col("new"), "n_chars": F.when(F.size("spans") > 0, F.length("new").cast("long")).otherwise(F.col("row.n_chars"))}
    return out.select(*[values.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
