"""Every query that has SQL, against DuckDB, over whole tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tessella.queries import ORACLE_SQL, QUERIES


def plain(df):
    def cell(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        if isinstance(x, float):
            return round(x, 6)
        return bool(x) if type(x).__name__ in ("bool", "bool_") else int(x) if "int" in type(x).__name__ else str(x)

    return sorted((tuple(cell(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(sf):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf, duck, name):
    got, want = QUERIES[name](spark, sf).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_contract(spark, sf):
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 200
