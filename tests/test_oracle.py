"""Every query of the library itself against its SQL on the smallest test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from broadsheet.testbed import oracle
from broadsheet.testbed.queries import QUERIES
from check import database, difference
from conftest import SF


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ours = QUERIES[name](spark, SF).toPandas()
    assert difference(ours, con.sql(oracle.oracle_sql()[name]).df()) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
