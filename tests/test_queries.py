import pytest
from compare import database, difference

from __spark_entry__ import entry, oracle_sql, queries
from roadwatch.plans.oracles import ORACLES
from roadwatch.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, tables, name):
    differing, rows = difference(spark, QUERIES[name], ORACLES[name], SF_DIR, tables)
    assert not differing
    assert rows > 0


def test_entry(spark):
    assert entry(spark).count() > 0
