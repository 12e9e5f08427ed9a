"""Every registered query against its SQL on the smallest given tables."""

import pytest

import __spark_entry__ as contract
from footfall.registry import oracle, queries
from tests.compare import connect, difference
from tests.conftest import SMALL

QUERIES = queries.queries()


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(QUERIES) <= set(contract.queries())


def test_entry_has_a_stable_schema(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, connection, name):
    frame = QUERIES[name](spark, SMALL)
    _, problem = difference(frame, connection, oracle.oracle_sql()[name])
    assert problem is None, problem
