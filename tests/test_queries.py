"""Every query against its SQL."""

import compare
import pytest

import __spark_entry__ as contract
from emberwatch.plans.oracles import ORACLES as SQL
from emberwatch.plans.registry import QUERIES


@pytest.fixture(scope="module")
def connection(folder):
    with compare.database(folder) as database:
        yield database


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, spark, folder, connection):
    assert compare.difference(QUERIES[name](spark, folder), connection, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_rows(name, spark, folder):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    board = contract.entry(spark)
    assert board.count() == 10
    assert "status" in board.columns
