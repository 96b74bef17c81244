"""Every named query against the same result in SQL, over the smallest test data."""

import math
import os

import duckdb
import pandas as pd
import pytest
from conftest import SMALL

import __spark_entry__ as entry_point

ELSEWHERE = set(entry_point._llm_queries())
QUERIES = {n: f for n, f in entry_point.queries().items() if n not in ELSEWHERE}
ORACLES = {n: sql for n, sql in entry_point.oracle_sql().items() if n not in ELSEWHERE}


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{SMALL}/{name}')")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "year"):
        return str(pd.Timestamp(value))
    if isinstance(value, bool) or isinstance(value, str):
        return value
    if hasattr(value, "__len__"):
        return [plain(v) for v in value]
    return float(value)


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(repr([plain(v) for v in row]) for row in frame.itertuples(index=False))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    found = QUERIES[name](spark, SMALL).toPandas()
    wanted = database.execute(ORACLES[name]).fetchdf()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows_of(found) == rows_of(wanted)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "o_orderkey"
