"""Every registered query against DuckDB over the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    if name in ORACLES:
        assert differences(spark, duck, SF_DIR, QUERIES[name], ORACLES[name]) is None
    else:
        assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
