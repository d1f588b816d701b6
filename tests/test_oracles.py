"""Every registered query with an oracle equals it, on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 8
