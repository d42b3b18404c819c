"""Every registered query against its SQL counterpart on the given tables."""

import pytest

import __spark_entry__ as driver
from queries.catalogue import QUERIES
from queries.oracle import ORACLE
from tests.compare import check, connect

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = driver.queries()[name](spark, SF)
    assert check(result, con, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 10
