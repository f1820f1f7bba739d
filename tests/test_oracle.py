"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from newsloom.workload import ORACLES, QUERIES
from oracle import connect, difference
from settings import SF_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    query, sql = QUERIES[name], ORACLES.get(name)
    if sql is None:
        assert query(spark, SF_DIR).columns
    else:
        problem = difference(spark, con, name, query, sql, SF_DIR)
        assert problem is None, problem


def test_entry(spark):
    df = contract.entry(spark)
    assert "position" in df.columns and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
