"""Queries that give whole lists, on tables of their own."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from broadsheet.plans.skew import ranked
from broadsheet.testbed import oracle
from broadsheet.testbed.queries import QUERIES
from check import difference

NEW, KNOWN = 30, 70


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Readers of one category of 70 articles and one of 4; 30 new articles, alike but for their words."""
    folder = str(tmp_path_factory.mktemp("tables"))

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    when = dt.datetime(2024, 1, 9)
    clicks = [(1, 1), (1, 1), (1, 100), (2, 2)]
    write(
        "events", [(i, when, u, "click", 1.0, f'{{"k": {k}}}') for i, (u, k) in enumerate(clicks)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    )
    known = [(v, 0) for v in range(1, KNOWN + 1)] + [(v, 1) for v in range(100, 104)]
    write("embeddings", [(v, [0.5, float(v)], c) for v, c in known], "vec_id long, embedding array<float>, label int")
    texts = [(d, f"{('red', 'blue')[d % 2]} word{d} " * 3, "en", "a", 9) for d in range(NEW + 6)]
    write("documents", texts, "doc_id long, text string, lang string, source string, n_chars long")
    write("labels", [(d, d % 2, 0) for d in range(6)], "doc_id long, quality int, toxic int")
    return folder


def sql(folder, name):
    con = duckdb.connect()
    for table in ("events", "embeddings", "documents", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    return con.sql(oracle.oracle_sql()[name]).df()


def test_scores_of_all_articles_of_a_category(spark, tables):
    got = QUERIES["pref_join_scores"](spark, tables).toPandas()
    assert sorted(got[(got.user_id == 2) & (got.category == 0)].place) == list(range(1, KNOWN + 1))
    assert difference(got, sql(tables, "pref_join_scores")) == ""


def test_the_whole_order_of_a_user(spark, tables):
    got = QUERIES["user_score_order"](spark, tables).toPandas()
    assert sorted(got[got.user_id == 1]["rank"]) == list(range(1, KNOWN + 5))
    assert difference(got, sql(tables, "user_score_order")) == ""


def test_all_new_articles_of_the_categories_read(spark, tables):
    got = QUERIES["recommend_new_articles"](spark, tables).toPandas()
    assert sorted(got[got.user_id == 1]["rank"]) == list(range(1, NEW + 1))
    assert difference(got, sql(tables, "recommend_new_articles")) == ""


def test_a_null_group_is_numbered_over_all_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = spark.range(3000).select(F.lit(None).cast("long").alias("k"), "id")
        places = ranked(many, [(F.col("id"), "asc")], "place", ["k"])
        assert places.where("place = id + 1").count() == 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
