"""Every registered query against its SQL on the smallest data folder."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from bindscope.plans.views import TABLES

FOLDER = "/root/testdata/sf0.001"


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(value + 0.0) if isinstance(value, float) else str(value)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_matches_sql(spark, db, name):
    got = entry_point.queries()[name](spark, FOLDER).toArrow()
    columns = sorted(got.column_names)
    left = sorted(zip(*[[plain(v) for v in got.column(c).to_pylist()] for c in columns]), key=str)
    cur = db.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    right = sorted([tuple(plain(row[i]) for i in at) for row in cur.fetchall()], key=str)
    assert left == right


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql())))
def test_rows_only(spark, name):
    assert entry_point.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
