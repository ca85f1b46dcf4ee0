import pytest

from oracle_check import compare, database
from weektide.plans.catalog import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL), con, ORACLES[name]) == []


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
