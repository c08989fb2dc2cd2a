"""Column functions against hand-worked values."""

import datetime as dt
import hashlib
import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from broadsheet.functions import scores, text, times


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values()) or (0,)], list(values) or ["x"])
    return row.select(column.alias("v")).first()["v"]


def test_terms(spark):
    got = one(spark, text.terms(F.col("t")), t="Hello, WORLD-42 naïve_éa 中国 x")
    assert got == ["hello", "world", "42", "naïve", "éa", "中国", "x"]


def test_terms_of_empty_text(spark):
    assert one(spark, text.terms(F.col("t")), t="—!") == []


def test_bigrams_only_split_han_runs(spark):
    got = one(spark, text.terms_with_bigrams(F.col("t")), t="私人飞机G550型 plane 7")
    assert got == ["私人", "人飞", "飞机", "g550", "型", "plane", "7"]


def test_keyword_hash_trims(spark):
    want = hashlib.md5("飞机".encode()).hexdigest()
    assert one(spark, text.keyword_hash(F.col("t")), t=" 飞机 ") == want


def test_publish_time(spark):
    parse = times.parse_publish_time(F.col("t"))
    assert one(spark, parse, t="2014年03月04日05:06") == dt.datetime(2014, 3, 4, 5, 6)
    assert one(spark, parse, t="2014年3月4日5:06") == dt.datetime(2014, 3, 4, 5, 6)
    for bad in ("NULL", "", "2014-03-04", "2014年13月04日05:06"):
        assert one(spark, parse, t=bad) == dt.datetime(1970, 1, 1)


def test_age_counts_whole_hours(spark):
    age = times.age_hours(F.col("p").cast("timestamp_ntz"), F.col("n").cast("timestamp_ntz"))
    assert one(spark, age, p="2024-01-01 00:30:00", n="2024-01-01 02:29:59") == 1


def test_gravity_of_ten_articles_after_a_day(spark):
    value = one(spark, scores.gravity(F.col("v"), F.col("h")), v=10, h=24)
    assert math.isclose(value, 10 / 26**1.8) and round(value, 6) == 0.028382


def test_share_text(spark):
    share = scores.share_text(F.col("s"))
    cases = {8 / 9: "0.889", 1 / 9: "0.111", 0.0: "0.00", 0.5: "0.50", 1.0: "1.00", 0.0625: "0.062"}
    for value, want in cases.items():
        assert one(spark, share, s=value) == want


def test_decay_halves(spark):
    assert one(spark, scores.decay(F.col("h"), 24), h=48.0) == 0.25


def test_hour_slot(spark):
    slot = times.hour_slot(F.col("t").cast("timestamp_ntz"), 4)
    assert one(spark, slot, t="2024-01-01 23:59:00") == 5


def test_term_frequency_two_of_seventeen(spark):
    assert round(one(spark, F.col("n") / F.col("d"), n=2, d=17), 8) == 0.11764706


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 400).flatmap(lambda d: st.tuples(st.integers(1, d), st.just(d))))
def test_counts_can_be_recovered(spark, pair):
    n, length = pair
    got = one(spark, scores.recover_count(F.col("tf"), F.col("d")), tf=n / length, d=length)
    assert got == n
