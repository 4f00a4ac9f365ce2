"""Every registered query against its SQL over the whole given tables."""

import pytest

import __spark_entry__ as driver
from workload.catalog import ORACLES, QUERIES
from tests.compare import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
