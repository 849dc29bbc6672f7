from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from marketlake.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in got.columns]
    key = lambda r: [(v is None or (isinstance(v, float) and math.isnan(v)), str(v)) for v in r]
    assert sorted(map(tuple, got.collect()), key=key) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=key)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_others_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
