"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check import duck, rows_of
from voltmart.suite import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql() -> duckdb.DuckDBPyConnection:
    return duck(SF)


def test_entry_returns_rows(spark):
    assert spark_entry.entry(spark).count() == 31


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sql, name):
    df = QUERIES[name](spark, SF)
    result = sql.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())
