"""Every registered query with SQL gives the SQL's rows."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    return x


def test_entry(spark):
    assert entry.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    found = duck.sql(ORACLE[name])
    at = [found.columns.index(c) for c in columns]
    assert sorted(found.columns) == columns
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0
