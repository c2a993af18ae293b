"""Every query with SQL against DuckDB on the smallest tables; the others for rows and shape."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = entry.catalog.QUERIES, entry.catalog.ORACLE_SQL


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def shown(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    order = sorted(columns)
    mine = sorted(tuple(shown(r[c]) for c in order) for r in got.collect())
    theirs = sorted(tuple(shown(r[columns.index(c)]) for c in order) for r in want.fetchall())
    assert mine == theirs


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0
