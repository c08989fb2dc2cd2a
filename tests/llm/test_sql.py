"""Queries over the smallest tables against their SQL, and all of them for the rows they give."""

import pytest

import corpus_pipeline
from broadsheet.llm.queries import QUERIES, SQL
from check import database, difference

SF = "/root/testdata/sf0.001"
OWN_TEST = {"op11_collocations", "op12_conversation_trie"}


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(set(SQL) - OWN_TEST))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF).toPandas(), con.sql(SQL[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_a_row_for_each_document(spark, name):
    table = "pages" if "html" in name else "documents"
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_all_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
