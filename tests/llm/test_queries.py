"""Registered queries of the operators against their SQL on the given tables."""

import pytest

import __spark_entry__ as driver
from corploom.llm.queries import ORACLES, QUERIES
from tests.conftest import DATA
from tests.test_oracle import TYPES, duck, keyed, same  # noqa: F401


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):  # noqa: F811
    mine, theirs = QUERIES[name](spark, DATA), duck.sql(ORACLES[name])
    cols = sorted(mine.columns)
    assert cols == sorted(theirs.columns)
    kinds = dict(zip(theirs.columns, map(str, theirs.types)))
    assert {c: TYPES[t] for c, t in mine.dtypes} == kinds
    left = keyed(tuple(r[c] for c in cols) for r in mine.collect())
    order = [theirs.columns.index(c) for c in cols]
    right = keyed(tuple(r[i] for i in order) for r in theirs.fetchall())
    assert len(left) == len(right) > 0
    for a, b in zip(left, right):
        assert all(map(same, a, b)), (a, b)
