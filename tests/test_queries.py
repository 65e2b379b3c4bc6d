"""Every query with SQL gives the rows DuckDB gives on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLE = contract.oracle_sql()


def _rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    def text(v):
        return "~" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(v + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(text(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, df.collect()) == _rows(names, want)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
