"""Every named query that SQL can express, against DuckDB over the smallest test data."""

import os

import duckdb
import pytest

from tablelift.llm.queries import oracle_sql, queries

from .conftest import SMALL


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{SMALL}/{name}')")
    return con


@pytest.mark.parametrize("name", oracle_sql())
def test_query(spark, database, name):
    found = queries()[name](spark, SMALL).toPandas()
    wanted = database.execute(oracle_sql()[name]).fetchdf()
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns
    rows = [sorted(map(repr, df[columns].itertuples(index=False, name=None))) for df in (found, wanted)]
    assert rows[0] == rows[1]


def test_every_operator_is_named():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
