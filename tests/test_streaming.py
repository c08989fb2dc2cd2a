"""Streams of several files: same sums as in one batch, late rows, replays."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import profiles
from broadsheet.streaming import clicks as streams

CLICKS = "user_id long, news_id long, click_ts timestamp_ntz"


@pytest.fixture
def feed(spark, frame, tmp_path):
    """Click files that arrive one after the other."""

    def make(batches):
        folder = tmp_path / "feed"
        for i, batch in enumerate(batches):
            part = frame(batch, CLICKS).coalesce(1)
            part.write.parquet(str(folder / f"b{i}"))
        source = (
            spark.readStream.schema(CLICKS)
            .option("maxFilesPerTrigger", 1)
            .option("latestFirst", False)
            .option("recursiveFileLookup", True)
            .parquet(str(folder))
        )
        return source, spark.read.option("recursiveFileLookup", True).schema(CLICKS).parquet(str(folder))

    return make


@pytest.fixture
def tags(frame):
    return frame([(5, "a", 0.5), (5, "b", 0.25), (6, "a", 1.0)], "news_id long, term string, weight double")


def batches(at):
    return [
        [(1, 5, at(0)), (2, 6, at(1))],
        [(1, 6, at(25)), (1, 99, at(26))],
        [(1, 5, at(49)), (2, 5, at(50))],
    ]


def test_running_profile_equals_batch(feed, tags, at, rows):
    stream, batch = feed(batches(at))
    got = streams.run_updates(stream, streams.running_profile(tags))
    want = profiles.keyword_profile(batch, tags)
    assert rows(got, "user_id", "term", "weight") == rows(want, "user_id", "term", "weight")


def test_running_decay_equals_half_life(feed, tags, at):
    stream, batch = feed(batches(at))
    now = F.lit(at(72)).cast("timestamp_ntz")
    kept = streams.run_updates(stream, streams.running_decay(tags))
    got = {(r["user_id"], r["term"]): r["weight"] for r in streams.decay_to(kept, now).collect()}
    want = {(r["user_id"], r["term"]): r["weight"] for r in profiles.decayed_profile(batch, tags, now).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k]) for k in want)


def test_one_batch_is_read_without_a_shuffle(spark, frame, tags, at, tmp_path):
    """A change, or a snapshot without later changes, has every key once; two changes are put together."""
    shuffles = lambda df: (lambda p: p[p.index("Physical Plan") :].count("Exchange "))(df._jdf.queryExecution().toString())
    for name, running in (("sums", streams.running_profile(tags)), ("decay", streams.running_decay(tags))):
        table = str(tmp_path / name)
        streams._mark(spark, table, [])
        read = []
        for epoch in range(4):
            streams.record(running, table, frame([(1, 5, at(epoch)), (1, 5, at(epoch)), (2, 6, at(epoch))], CLICKS), epoch, 3)
            read.append(streams.latest(spark, table, running))
        assert [shuffles(df) > 0 for df in read] == [False, True, False, True]
        assert [df.count() for df in read] == [3] * 4
        assert all(df.columns == read[1].columns for df in read)


def test_decay_over_thousands_of_half_lives(spark, frame, tags, at, tmp_path):
    """Clicks 5,000 half-lives apart, the newest batch last, first and in between."""
    table, running = str(tmp_path / "decayed"), streams.running_decay(tags, 24.0)
    streams._mark(spark, table, [])
    for epoch, hours in enumerate((0, 5000 * 24, 24, 5000 * 24 - 24)):
        streams.record(running, table, frame([(1, 5, at(hours)), (2, 6, at(hours))], CLICKS), epoch, 2)
    kept = streams.latest(spark, table, running)
    now = F.lit(at(5000 * 24)).cast("timestamp_ntz")
    got = {(r["user_id"], r["term"]): r["weight"] for r in streams.decay_to(kept, now).collect()}
    assert got == {(1, "a"): 0.75, (1, "b"): 0.375, (2, "a"): 1.5}


def test_fifty_batches_read_few_files(spark, frame, tmp_path):
    counts = streams.Running(
        lambda clicks: clicks.groupBy("user_id").agg(F.count(F.lit(1)).alias("clicks")).coalesce(1),
        lambda rows: rows.groupBy("user_id").agg(F.sum("clicks").alias("clicks")).coalesce(1),
    )
    table = str(tmp_path / "counts")
    streams._mark(spark, table, [])
    for epoch in [*range(50), 49]:  # the last one is replayed
        streams.record(counts, table, spark.range(epoch % 3 + 1).withColumnRenamed("id", "user_id"), epoch, 8)
    got = streams.latest(spark, table, counts)
    assert {r["user_id"]: r["clicks"] for r in got.collect()} == {0: 50, 1: 33, 2: 16}
    # the scan of changes takes the two epochs after the last snapshot only
    plan = got._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(epoch#\d+\), \(epoch#\d+ > 47\)\]", plan)


def test_a_hot_article_meets_several_tasks(spark, frame, at, tmp_path):
    """Nine of ten clicks of a batch on one article."""
    tags = frame([(n, f"t{i}", 1.0) for n in range(20) for i in range(5)], "news_id long, term string, weight double")
    clicks = spark.range(5000).select(F.col("id").alias("user_id"), F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id") % 20).alias("news_id"), F.lit(at(1)).cast("timestamp_ntz").alias("click_ts"))
    settings = {"adaptive.coalescePartitions.enabled": "false", "adaptive.autoBroadcastJoinThreshold": "-1", "autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        counted = clicks.groupBy("user_id", "news_id").agg(F.count(F.lit(1)).alias("amount"))
        joined = profiles.clicks_with_keywords(counted, tags)
        per_task = [r["count"] for r in joined.where("news_id = 7").groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) > 3 and sum(per_task) == 5 * 4500
    finally:
        for name in settings:
            spark.conf.unset(f"spark.sql.{name}")
    table, running = str(tmp_path / "hot"), streams.running_profile(tags)
    streams._mark(spark, table, [])
    streams.record(running, table, clicks, 0)
    assert streams.latest(spark, table, running).count() == 25_000


def test_category_counts(feed, frame, at, rows):
    stream, _ = feed(batches(at))
    known = frame([(5, at(0), 1), (6, at(0), 2)], "news_id long, publish_ts timestamp_ntz, category int")
    timed = stream.withColumn("publish_ts", F.lit(at(0)).cast("timestamp_ntz"))
    got = streams.run_updates(timed, streams.running_categories(known))
    assert rows(got, "user_id", "category", "clicks") == [(1, 1, 2), (1, 2, 1), (2, 1, 1), (2, 2, 1)]


def test_days_come_out_once_over_and_late_clicks_are_left_out(feed, at, rows):
    late = (9, 5, at(2))
    # a batch is held against the watermark of the batch before the last
    hours = [[1, 5], [30], [31]]
    stream, _ = feed([[(1, 5, at(h)) for h in batch] for batch in hours] + [[late], [(1, 5, at(60))]])
    got = rows(streams.run_append(streams.daily_click_stream(stream)), "day", "slot", "clicks")
    assert got == [
        (dt.date(2024, 1, 1), 0, 1),
        (dt.date(2024, 1, 1), 1, 1),
        (dt.date(2024, 1, 2), 1, 2),
    ]


def test_a_stopped_stream_goes_on_where_it_was(spark, feed, tags, at, tmp_path, rows):
    stream, batch = feed(batches(at))
    table, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):  # the second run finds nothing new
        streams.start_updates(stream, streams.running_profile(tags), table, state, 2, availableNow=True).awaitTermination()
    got = streams.latest(spark, table, streams.running_profile(tags))
    want = profiles.keyword_profile(batch, tags)
    assert rows(got, "user_id", "term", "weight") == rows(want, "user_id", "term", "weight")


def test_a_stream_without_input_gives_no_rows(spark, frame, tmp_path):
    (tmp_path / "empty").mkdir()
    feed = spark.readStream.schema(CLICKS).parquet(str(tmp_path / "empty"))
    tags = frame([(5, "a", 1.0)], "news_id long, term string, weight double")
    assert streams.run_updates(feed, streams.running_profile(tags)).collect() == []
    assert streams.run_append(streams.daily_click_stream(feed)).collect() == []
