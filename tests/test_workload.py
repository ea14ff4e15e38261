"""Every registered query against DuckDB on the given tables."""

import pytest

import __spark_entry__ as driver
from tillwise import workload
from compare import connect, differences

SF = "/root/testdata/sf0.001"
# The text operators have tests of their own.
QUERIES = workload.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(workload.oracle_sql()) and set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, driver.oracle_sql()[name]) == []


def test_entry(spark):
    assert driver.entry(spark).columns == ["store_id", "category_id", "transaction_date", "total_sales"]
    assert not driver.entry(spark).isEmpty()
