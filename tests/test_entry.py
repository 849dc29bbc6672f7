from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from marketlake.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, float):  # sums depend on their order
        return str(int(v)) if v.is_integer() else f"{v:.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, sf, name):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        if Path(f"{sf}/{t}.parquet").exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    a = sorted([plain(r[c]) for c in sorted(got.columns)] for r in got.collect())
    at = [want.columns.index(c) for c in sorted(want.columns)]
    assert a == sorted([plain(r[i]) for i in at] for r in want.fetchall())
