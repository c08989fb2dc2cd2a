"""Plans of the main queries: what is read, joined and shuffled."""

import re

import pytest

from __spark_entry__ import queries
from conftest import SF

NAMES = [
    "tfidf", "top_keywords", "title_body_keywords", "doc_term_matrix", "new_doc_matrix",
    "clicks_join_category", "clicks_join_keywords", "user_keyword_profile", "decayed_profile",
    "gravity_score", "pref_join_scores", "recommend_by_preference", "recommend_by_overlap",
    "overlap_counts", "naive_bayes_predict", "kmeans_assign", "doc_vocab_zero_fill",
    "doc_term_dense", "attach_titles", "user_preference_matrix",
]


def physical(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("Physical Plan") :]


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_joins_and_no_python_rows(spark, name):
    plan = physical(queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", ["tfidf", "top_keywords", "doc_lengths", "doc_frequency"])
def test_only_the_needed_columns_are_read(spark, name):
    plan = physical(queries()[name](spark, SF))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)) <= {
        "doc_id:bigint,text:string", "doc_id:bigint", "text:string",
    }


def test_clicks_are_filtered_in_the_scan(spark):
    plan = physical(queries()["user_category_counts"](spark, SF))
    assert "PushedFilters: [In(event_type, [click,view])]" in plan


def test_counting_terms_shuffles_texts_once(spark):
    plan = physical(queries()["term_counts"](spark, SF))
    assert plan.count("Exchange") == 1
    assert "REPARTITION_BY_COL" in plan


def test_terms_are_split_after_the_shuffle_only(spark):
    plan = physical(queries()["term_counts"](spark, SF))
    exchange = plan.index("Exchange")
    assert plan.count("regexp_extract_all") == 1
    assert plan.index("regexp_extract_all") < exchange


def test_tables_are_not_broadcast_on_a_guess(spark):
    plan = physical(queries()["clicks_join_category"](spark, SF))
    hints = len(re.findall(r"BroadcastHashJoin", plan))
    assert hints == 2  # the hot keys, on both sides
    assert "SortMergeJoin" in plan
