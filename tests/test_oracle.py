"""Every registered query against its SQL twin, row by row."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from rillmart.plans.oracle import oracle_sql
from rillmart.plans.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
QUERIES = REGISTRY
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
