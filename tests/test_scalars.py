from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from bindscope.functions import scalars as S


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("o")).first().o


def test_fixed_text_rounds_like_printf(spark):
    rng = random.Random(1)
    values = [0.0625, 0.1875, 2.5, 1.0005, 0.0005, 300.0, 1e-9, 123456.7895] + [rng.uniform(-50, 50) for _ in range(500)] + [k / 16 for k in range(64)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.o for r in df.select(S.fixed_text("v", 3).alias("o")).collect()]
    assert got == [f"{v:.3f}" for v in values]


def test_render_number(spark):
    df = spark.createDataFrame([(300.0,), (1.5,), (0.0625,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert [r.o for r in df.select(S.render_number("v").alias("o")).collect()] == ["300", "1.5", "0.062", "", "", ""]


@pytest.mark.parametrize(
    "value,want",
    [("mini-binder", "mp"), ("miniprotein", "mp"), ("SC fv", "scfv"), (" VHH ", "vhh"), ("", "binder"), (None, "binder")],
)
def test_binder_code(spark, value, want):
    assert one(spark, value, S.binder_code("v")) == want


def test_opt_bool(spark):
    for text, want in (("TRUE", True), (" yes", True), ("1", True), ("0", False), ("no", False), ("2", None), ("", None)):
        assert one(spark, text, S.opt_bool("v")) is want
    assert spark.range(1).select(S.opt_bool("id", "bigint").alias("o")).first().o is None


def test_canonical_hash_equals_json(spark):
    df = spark.createDataFrame([("a\"b\\c", 3, None)], "s string, n bigint, m string")
    fields = {"zeta": F.col("s"), "alpha": F.col("n"), "mid": F.col("m")}
    row = df.select(S.canonical_json(fields).alias("c"), S.canonical_json(fields, True).alias("p"), S.canonical_hash(fields, n=16).alias("h")).first()
    doc = {"zeta": 'a"b\\c', "alpha": 3, "mid": None}
    assert row.c == json.dumps(doc, sort_keys=True, separators=(",", ":"))
    assert row.p == json.dumps(doc, sort_keys=True)
    assert row.h == hashlib.sha256(row.c.encode()).hexdigest()[:16]


def test_zero_pad_never_cuts(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "n bigint")
    assert [r.o for r in df.select(S.zero_pad("n", 4).alias("o")).collect()] == ["0007", "1234567"]


def test_strict_metrics_name_the_row(spark):
    df = spark.createDataFrame([("x1", "[1]")], "id string, j string")
    with pytest.raises(Exception, match="invalid metrics JSON for x1"):
        df.select(S.decode_metrics("j", "id").alias("d")).collect()
    assert df.select(F.size(S.decode_metrics("j", "id", lenient=True)).alias("n")).first().n == 0


def test_first_present_keeps_explicit_null(spark):
    df = spark.createDataFrame([('{"a":null,"b":"2"}', '{"c":"3"}')], "x string, y string")
    d = df.select(F.from_json("x", S.JSON_MAP).alias("x"), F.from_json("y", S.JSON_MAP).alias("y"))
    row = d.select(S.first_present("x", "y", ("a", "b")).alias("p"), S.first_present("x", "y", ("q", "c")).alias("q"), S.first_nonempty(F.lit(""), F.lit("z")).alias("n")).first()
    assert (row.p, row.q, row.n) == (None, "3", "z")


def test_bins(spark):
    mids = spark.range(1).select(S.bin_midpoints().alias("m")).first().m
    assert len(mids) == 128 and mids[0] == 1.5 and mids[-1] == 54.5 and mids[1] == pytest.approx(2 + 25 / 126)
    df = spark.createDataFrame([(1.0,), (2.0,), (2.3125,), (2.32,), (21.9,), (99.0,)], "d double")
    assert [r.o for r in df.select(S.distance_bin("d").alias("o")).collect()] == [0, 0, 0, 1, 63, 63]


def test_stale_cutoff():
    assert S.stale_seconds(10) == 90.0 and S.stale_seconds(40) == 120.0


def test_quoted_number_of_any_length(spark):
    from bindscope.functions.scalars import repair_quoted_number

    text = "'" + "0" * (1 << 20) + "7"
    got = spark.createDataFrame([(text,), ("'2.50",)], "x string").select(repair_quoted_number("x").alias("y")).collect()
    assert [r.y for r in got] == ["7", "2.5"]
