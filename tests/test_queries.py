"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as contract
from sparkgrad import catalog
from tools.check_queries import compare, connect


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, database, sf_dir, name):
    ok, message = compare(spark, database, name, sf_dir)
    assert ok, message


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["id", "label", "prediction", "output", "p"]
    assert df.count() == 5000


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(catalog.QUERIES) <= set(contract.queries()) and set(catalog.SQL) <= set(contract.oracle_sql())
