"""Every registered query against its SQL twin, on the smallest data set."""

import pytest

import __spark_entry__ as contract
from aislecast.plans.queries import QUERIES, SQL
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    assert contract.entry(spark).columns[:4] == ["id", "store_id", "sku", "date"]


def test_contract():
    """The driver sees all queries of the library, whatever else is installed."""
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert not df.isEmpty()
