"""Every registered query against its SQL on the given tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

from .conftest import DATA

QUERIES = {name: query for name, query in driver.queries().items() if name in driver.QUERIES}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name in driver.ORACLES}
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def keyed(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12)
    return a == b


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    mine = QUERIES[name](spark, DATA)
    theirs = duck.sql(ORACLES[name])
    cols = sorted(mine.columns)
    assert cols == sorted(theirs.columns)
    kinds = dict(zip(theirs.columns, map(str, theirs.types)))
    assert {c: TYPES[t] for c, t in mine.dtypes} == kinds
    left = keyed(tuple(r[c] for c in cols) for r in mine.collect())
    order = [theirs.columns.index(c) for c in cols]
    right = keyed(tuple(r[i] for i in order) for r in theirs.fetchall())
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert all(map(same, a, b)), (a, b)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
