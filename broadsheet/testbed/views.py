"""The test tables seen as news, clicks and categories."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.functions.times import parse_publish_time
from broadsheet.plans.skew import salted_join
from broadsheet.settings import NULL_TEXT, PUBLISH_PATTERN_OUT

AS_OF = "timestamp_ntz'2024-01-31 00:00:00'"
LATE_CLICKS = "timestamp_ntz'2024-01-16 00:00:00'"
READERS = 97  # who open each article once
STREAM_START = "timestamp_ntz'2024-01-01 00:00:00'"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_of() -> Column:
    return F.expr(AS_OF)


def _publish_ts(doc: str) -> Column:
    # the tables have no publish time; each article gets an hour of one month
    return F.expr(
        "timestamp_ntz'2024-01-01 00:00:00'"
        f" - make_interval(0, 0, 0, 0, cast({doc} % 720 as int))"
    )


def _publish_text(doc: str) -> Column:
    # as in the click log, some articles come without a time
    known = F.date_format(_publish_ts(doc), PUBLISH_PATTERN_OUT)
    return F.when(F.col(doc) % 7 == 0, F.lit(NULL_TEXT)).otherwise(known)


def news(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("news_id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("content"),
        _publish_ts("doc_id").alias("publish_ts"),
        _publish_text("doc_id").alias("publish_text"),
    )


LETTERS = "abcdefghijklmnopqrstuvwxyz"
HAN = "".join(chr(0x4E00 + i) for i in range(len(LETTERS)))


def han_news(spark: SparkSession, sf: str) -> DataFrame:
    """The articles with a Han character in place of each Latin letter."""
    return news(spark, sf).withColumn("content", F.translate(F.lower("content"), LETTERS, HAN))


def _as_clicks(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin("click", "view")).select(
        "user_id",
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("news_id"),
        F.col("ts").alias("click_ts"),
    )


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    return _as_clicks(table(spark, sf, "events"))


def click_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same clicks as a stream of files."""
    schema = table(spark, sf, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    )
    return _as_clicks(events)


def raw_log(spark: SparkSession, sf: str) -> DataFrame:
    """The click log with the article in every line.

    Besides the clicks each article is opened once by a reader of its own, so
    the log holds all of them. Every third article was changed in the middle of
    the month: clicks show the version of their time, and the new version is
    opened once more.
    """
    texts = news(spark, sf).select("news_id", "title", "content", "publish_text")
    opened = texts.select(
        (F.col("news_id") % READERS).alias("user_id"),
        "news_id",
        (F.expr(STREAM_START) + F.make_interval(secs=F.col("news_id") % 86_400)).alias("click_ts"),
    )
    again = opened.where(F.col("news_id") % 3 == 0).withColumn("click_ts", F.col("click_ts") + F.expr("interval 20 days"))
    clicked = clicks(spark, sf).unionByName(opened).unionByName(again)
    rows = clicked.groupBy("news_id").agg(F.count(F.lit(1)).alias("rows"))
    joined = salted_join(clicked, texts, "news_id", rows, "rows", clicked.columns)
    changed = (F.col("news_id") % 3 == 0) & (F.col("click_ts") >= F.expr(LATE_CLICKS))
    return joined.select(
        "user_id",
        "news_id",
        "click_ts",
        F.when(changed, F.concat(F.lit("Update: "), "title")).otherwise(F.col("title")).alias("title"),
        F.when(changed, F.concat("content", F.lit(" (updated)"))).otherwise(F.col("content")).alias("content"),
        "publish_text",
    )


def timed_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks with the publish time the log gives for the article."""
    return clicks(spark, sf).withColumn(
        "publish_ts", parse_publish_time(_publish_text("news_id"))
    )


def with_publish_time(some_clicks: DataFrame) -> DataFrame:
    return some_clicks.withColumn("publish_ts", parse_publish_time(_publish_text("news_id")))


def assignment(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("news_id"),
        _publish_ts("vec_id").alias("publish_ts"),
        F.col("label").alias("category"),
    )


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(
        F.col("doc_id").alias("news_id"), F.col("quality").alias("label")
    )


def train_news(spark: SparkSession, sf: str) -> DataFrame:
    return news(spark, sf).join(labels(spark, sf), "news_id", "left_semi")


def new_news(spark: SparkSession, sf: str) -> DataFrame:
    return news(spark, sf).join(labels(spark, sf), "news_id", "left_anti")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "embedding")
