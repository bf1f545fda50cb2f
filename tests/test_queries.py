"""Every registered query against its SQL on the smallest tables, and the driver contract."""

import pytest

import __spark_entry__ as contract
from newslens.plans import load_all
from tests.compare import compare, connect

QUERIES = load_all()
MAY_BE_EMPTY = {"a2_drop_duplicates"}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_matches_sql(spark, con, folder, name):
    ok, message = compare(spark, con, QUERIES[name], folder)
    assert ok, message


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["year_month", "category", "n"]
