"""Quality rules: how far a text's histograms lie from those of its language.

Two histograms of a text, of its character classes and of common words, are compared to
the language's by Jensen-Shannon distance (square root of the divergence to base 2, so 0 to
1). References are totals over all documents of the language; a language outside
``COMMON`` (or none) has the totals over all documents. A text with fewer than
``min_chars`` characters or ``min_words`` words isn't judged by the histogram concerned,
as short texts are far from any reference by chance.

Nulls and odd rows: a null, empty or wordless text has 0 everywhere and fails the base rules;
repeated rows each return a row; a row without id keeps its null id; other columns are
ignored; on an empty table the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindscope.llm.tokens import SPACE, U, Spans, Words, mix, slices, window_starts

#: Frequent function words of each language.
COMMON = {
    "en": "the of and to in a is that for it as was with be by on not he this are or his from at which but have an they i".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux ou".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si".split(),
}
LANGUAGES = [*COMMON, "*"]
VOCABULARY = sorted({w for words in COMMON.values() for w in words})
SYMBOLS = b"#*$%&|<>"
CLASSES = 8
#: Text bytes that are counted at once: a worker's arrays take some 60 times as many.
SLICE = 1 << 20

# Classes: space, lower, upper, digit, stop or quote, symbol, other ASCII, beyond ASCII.
CLASS = np.full(256, 6, np.uint8)
CLASS[SPACE] = 0
CLASS[ord("a") : ord("z") + 1] = 1
CLASS[ord("A") : ord("Z") + 1] = 2
CLASS[ord("0") : ord("9") + 1] = 3
CLASS[list(b".,;:!?'\"()-")] = 4
CLASS[list(SYMBOLS)] = 5
CLASS[0x80:] = 7
CLASS[0x80:0xC0] = 8  # not the start of a character

RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, class_distance double, word_distance double, kept boolean"
)


def word_hashes(words: list[str]) -> np.ndarray:
    return Words(pa.array(words)).hashes()


def _word_counts(words: Words, known: np.ndarray, order: np.ndarray) -> np.ndarray:
    hashes = words.hashes()
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    number = np.where(known[at] == hashes, order[at], len(known))
    size = len(known) + 1
    return np.bincount(words.row * size + number, minlength=words.rows * size).reshape(words.rows, size)


def both_histograms(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    plain = Words(column)
    classes = _classes(plain)
    known = word_hashes(VOCABULARY)
    order = np.argsort(known)
    return plain, classes, _word_counts(Words(column, lower=True), known[order], order)


def _classes(words: Words) -> np.ndarray:
    size = CLASSES + 1
    row = np.repeat(np.arange(words.rows, dtype=np.int64), np.diff(words.at))
    counts = np.bincount(row * size + CLASS[words.data], minlength=words.rows * size)
    return counts.reshape(words.rows, size)[:, :CLASSES]


def language_numbers(column: pa.Array) -> np.ndarray:
    at = pc.index_in(column, pa.array(list(COMMON)))
    return at.fill_null(len(COMMON)).to_numpy(zero_copy_only=False).astype(np.int64)


def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all rows of a task, by language: (language, kind, number, n)."""
    classes = np.zeros((len(LANGUAGES), CLASSES), np.int64)
    words = np.zeros((len(LANGUAGES), len(VOCABULARY) + 1), np.int64)
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            _, c, w = both_histograms(part.column(0))
            language = language_numbers(part.column(1))
            np.add.at(classes, language, c)
            np.add.at(words, language, w)
    for kind, counts in ((0, classes), (1, words)):
        language, number = np.nonzero(counts)
        yield pa.record_batch(
            [pa.array(language, pa.int32()), pa.array(np.full(len(number), kind), pa.int32()),
             pa.array(number, pa.int32()), pa.array(counts[language, number], pa.int64())],
            names=["language", "kind", "number", "n"],
        )


def references(docs: DataFrame) -> list[np.ndarray]:
    """Reference distributions: languages (and, last, all) by class, and by word. At most
    a few hundred numbers reach the driver, whatever the input."""
    out = [np.zeros((len(LANGUAGES), CLASSES)), np.zeros((len(LANGUAGES), len(VOCABULARY) + 1))]
    rows = docs.select("text", "lang").mapInArrow(totals, "language int, kind int, number int, n long")
    for r in rows.groupBy("language", "kind", "number").agg(F.sum("n").alias("n")).collect():
        out[r.kind][r.language, r.number] = r.n
    for counts in out:
        counts[-1] = counts.sum(axis=0)
        counts += 0.5  # so a class or word not seen has a small chance
        counts /= counts.sum(axis=1, keepdims=True)
    return out


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts from its row of the reference."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(reference > 0, reference * np.log2(reference / m), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 0.0)


def duplicate_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    if not text or "\n" not in text:
        return 0
    seen: set[str] = set()
    found = 0
    for line in text.split("\n"):
        if line in seen:
            found += bool(line.strip(" \t\x0b\x0c\r"))
        else:
            seen.add(line)
    return found


def repeated_words(words: Words, width: int) -> np.ndarray:
    """Per row: words in windows of ``width`` words that its text has twice or more."""
    start = window_starts(words, width)
    row = words.row[start]
    key = mix(Spans(words.hashes())(start, start + width) + U(0x9E3779B97F4A7C15) * (row + 1).astype(np.uint64))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    step = np.zeros(len(words.row) + 1, np.int64)
    step[start[again]] += 1
    step[start[again] + width] -= 1
    covered = np.cumsum(step)[:-1] > 0
    return np.bincount(words.row[covered], minlength=words.rows)


def judge(reference: list[np.ndarray], min_chars: int, min_words: int, class_limit: float, word_limit: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words, classes, common = both_histograms(part.column(1))
                language = language_numbers(part.column(2))
                n = words.count
                repeat = repeated_words(words, 8)
                failed = (n < 20) | (100 * repeat > 30 * n)
                chars = classes[:, 1:].sum(axis=1)
                c = distance(classes, reference[0][language])
                w = distance(common, reference[1][language])
                far = (chars >= min_chars) & (c > class_limit) | (n >= min_words) & (w > word_limit)
                lines = [duplicate_lines(t) for t in part.column(1).to_pylist()]
                yield pa.record_batch(
                    [part.column(0), *(pa.array(x, pa.int64()) for x in (n, chars, classes[:, 5], lines, repeat)),
                     pa.array(failed), pa.array(c), pa.array(w), pa.array(~failed & ~far)],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "class_distance", "word_distance", "kept"],
                )

    return rows


def judged(
    docs: DataFrame, min_chars: int = 400, min_words: int = 150, class_limit: float = 0.26, word_limit: float = 0.32
) -> DataFrame:
    """Counts, distances and verdict of each document (columns: ``RESULT``)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return rows.mapInArrow(judge(references(rows), min_chars, min_words, class_limit, word_limit), RESULT)


def keep(docs: DataFrame, **limits: float) -> DataFrame:
    """The rows of ``docs`` whose verdict is to keep them. Verdicts are found per row, in
    one pass without a shuffle; other columns travel along."""
    reference = references(docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")))
    options = {"min_chars": 400, "min_words": 150, "class_limit": 0.26, "word_limit": 0.32} | limits
    verdict = judge(reference, **options)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            length = batch.num_rows
            narrow = pa.record_batch(
                [pa.array(np.arange(length)), batch.column(at("text")), batch.column(at("lang"))], names=["doc_id", "text", "lang"]
            )
            mask = [v.column(v.schema.get_field_index("kept")) for v in verdict(iter([narrow]))]
            if mask:
                yield batch.filter(pa.chunked_array(mask).combine_chunks())

    return docs.mapInArrow(rows, docs.schema)
