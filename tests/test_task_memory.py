"""What a task holds stays bounded: sizes of partitions, and joins that do not sort the rows of terms."""

import math
import random

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import keywords
from broadsheet.plans.session import SETTINGS, prepare, shuffle_partitions
from broadsheet.plans.skew import hot_keys


@pytest.fixture
def prepared(spark):
    """The session with the library's settings, and none of a test's own left behind."""
    own = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        **SETTINGS,
    }
    before = {name: spark.conf.get(name, None) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    yield prepare(spark)
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def executed(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.index("Initial Plan")]


def test_partitions_are_not_merged_to_more_than_a_task_can_sort(prepared):
    lines = prepared.range(0, 1_300_000, 1, 4).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    dealt = lines.repartition("id").groupBy(F.spark_partition_id().alias("at")).agg(F.count(F.lit(1)).alias("n"), F.max("text"))
    sizes = [r.n for r in dealt.collect()]
    assert sum(sizes) == 1_300_000
    assert len(sizes) > 2 and max(sizes) < 600_000


def test_a_sessions_few_partitions_do_not_make_large_tasks(prepared):
    prepared.conf.set("spark.sql.shuffle.partitions", "2")
    prepare(prepared)
    lines = prepared.range(0, 1_300_000, 1, 4).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    dealt = lines.repartition("id").groupBy(F.spark_partition_id().alias("at")).agg(F.count(F.lit(1)).alias("n"), F.max("text"))
    sizes = [r.n for r in dealt.collect()]
    assert sum(sizes) == 1_300_000
    assert len(sizes) > 2 and max(sizes) < 600_000
    keys = prepared.range(1000).select((F.col("id") % 10).alias("k"))
    weights = keys.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert shuffle_partitions(prepared) > 100  # so a key with a tenth of the rows is dealt over several tasks
    hot = hot_keys(weights, ["k"], "n", shuffle_partitions(prepared))
    assert [r["_salts"] for r in hot.collect()] == [103] * 10
    prepared.conf.set("spark.sql.shuffle.partitions", "3000")
    assert shuffle_partitions(prepare(prepared)) == 3000  # a session's larger number stays


@pytest.mark.parametrize("other_corpus", [False, True])
def test_rows_of_terms_are_not_sorted_for_their_frequency(prepared, frame, other_corpus):
    prepared.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")  # else so few are broadcast
    random.seed(3)
    texts = [(d, " ".join(f"w{random.randint(0, 40)}" for _ in range(30))) for d in range(50)] + [(50, None), (None, "w1 w2 w1")]
    news = frame(texts, "news_id long, content string")
    df = keywords.text_frequency(news, dealt=False)
    some = df.where("term <> 'w7'") if other_corpus else df
    scored = keywords.tfidf(keywords.term_counts(news), F.lit(51), some, other_corpus)
    plan = executed(scored)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    docs = [(d, t.split()) for d, t in texts if t]
    seen = {w: sum(w in t for _, t in docs) for w in {w for _, t in docs for w in t}}
    if other_corpus:
        seen["w7"] = 1
    want = {(d, w): round(t.count(w) / len(t) * math.log10(51 / seen[w]), 9) for d, t in docs for w in t}
    assert {(r.news_id, r.term): round(r.tfidf, 9) for r in scored.collect()} == want


@pytest.mark.parametrize("n", [3, 50])
def test_only_contenders_are_joined_for_the_heaviest_terms(spark, frame, monkeypatch, n):
    random.seed(9)
    weights = [1 / (i + 1) for i in range(300)]
    texts = [(d % 35, " ".join(f"w{i}" for i in random.choices(range(300), weights, k=150))) for d in range(40)]
    news = frame([*texts, (None, "w1 w2"), (None, "w2 w250"), (36, None), (37, "")], "news_id long, content string")
    joined, tfidf = [], keywords.tfidf
    monkeypatch.setattr(keywords, "tfidf", lambda counts, *more: joined.append(counts) or tfidf(counts, *more))
    read = lambda top: sorted((r.news_id or -1, r["rank"], r.term, r.n, round(r.tfidf, 9)) for r in top.collect())
    got, want = (read(keywords.top_keywords(keywords.article_tfidf(news, first=k), n)) for k in (n, None))
    assert got == want
    if n == 3:
        assert joined[0].count() < joined[1].count() / 3
