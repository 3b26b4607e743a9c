from __future__ import annotations

from bindscope.llm import decontaminate, ngram_join

SCHEMA = "doc_id long, text string, source string"
TEXT = " ".join(f"w{i}" for i in range(40))
OTHER = " ".join(f"v{i}" for i in range(40))


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=str)


def test_keep_one_of_rows_without_or_with_equal_ids(spark):
    rows = [(None, TEXT, "a"), (7, TEXT, "a"), (7, TEXT, "a"), (9, TEXT + " x", "a"), (None, OTHER, "a"), (None, OTHER, "b"),
            (7, "something else altogether", "a"), (3, None, "a"), (3, None, "a"), (4, None, "a"), (None, "", "a"), (None, "", "a")]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert kept.columns == ["doc_id", "text", "source"]
    got = [(i, t) for i, t, _ in rows_of(kept)]
    want = [(7, TEXT), (None, OTHER), (7, "something else altogether"), (3, None), (4, None), (None, "")]
    assert got == sorted(want, key=str)


def test_clean_finds_rows_and_items_without_id(spark):
    rows = [(None, TEXT, "a"), (None, OTHER, "a"), (5, TEXT, "a"), (5, "one two three", "a"), (6, "q " + OTHER, "b"), (None, "one two", "a")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    items = spark.createDataFrame([(1, TEXT), (None, OTHER)], "item_id long, text string")
    assert rows_of(decontaminate.clean(docs, items)) == sorted([rows[3], rows[5]], key=str)
    got = sorted([(r.doc_id, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, items).collect()], key=str)
    want = [(None, 40, 1, True), (None, 40, 0, True), (5, 40, 1, True), (5, 0, 0, False), (6, 40, 0, True), (None, 0, 0, False)]
    assert got == sorted(want, key=str)
