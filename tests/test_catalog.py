"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract
from logloom.plans import catalog, oracle
from tests.conftest import SMALL

TABLES = ("events", "documents")
QUERIES, SQL = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(frame):
    """Rows of a pandas frame, columns by name, missing values as None."""
    frame = frame[sorted(frame.columns)]
    def value(v):
        if v is None or v != v:
            return None
        return v
    return sorted((tuple(map(value, r)) for r in frame.itertuples(index=False, name=None)),
                  key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got, expected = QUERIES[name](spark, SMALL).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    left, right = plain(got), plain(expected)
    assert len(left) == len(right) > 0
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            same = math.isclose(x, y, rel_tol=1e-12) if isinstance(x, float) else x == y
            assert same, (name, a, b)


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() == 905 and "rps" in frame.columns
