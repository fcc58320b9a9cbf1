"""Every named query against its oracle."""

import oracle
import pytest

from tallymill.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(name, spark, sf_dir, connection):
    oracle.compare(QUERIES[name](spark, sf_dir), connection, ORACLES[name])


def test_entry_has_rows(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns == ["year", "month", "region", "country", "total_revenue", "total_quantity"]
    assert not driver.entry(spark).isEmpty()
    assert set(driver.oracle_sql()) <= set(driver.queries())
