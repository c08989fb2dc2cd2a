"""From the raw click log to the list of articles."""

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions.text import glue_key
from broadsheet.functions.times import epoch_millis, parse_publish_time
from broadsheet.plans.bitfilter import bit_filter, without_misses
from broadsheet.plans.storage import stored


def brief_clicks(log: DataFrame) -> DataFrame:
    """Who clicked what when; an id that is no number is null."""
    return log.select(
        *[F.trim(F.col(c).cast("string")).try_cast("bigint").alias(c) for c in ("user_id", "news_id")],
        "click_ts",
    )


def user_news_map(log: DataFrame) -> DataFrame:
    """The articles of every user with their publish time; repeated clicks stay."""
    return log.select(
        "user_id", "news_id", parse_publish_time(F.col("publish_text")).alias("publish_ts")
    )


def publish_times(log: DataFrame) -> DataFrame:
    """Publish time as epoch milliseconds, 0 where it cannot be read."""
    return log.withColumn(
        "publish_ms", epoch_millis(parse_publish_time(F.col("publish_text")))
    )


def article_keys(articles: DataFrame) -> DataFrame:
    """The glued key ``id|milliseconds`` of an article."""
    return articles.withColumn(
        "article_key", glue_key(F.col("news_id"), epoch_millis(F.col("publish_ts")))
    )


def _mark(*columns: str) -> Column:
    """One text for the values of several columns, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _one_line_each(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of the lines of each key the last by ``order``.

    Decided on a narrow table; then only lines that won are read with their
    texts. A filter of the winners is tested in that scan, so a text is shuffled
    once for each key, and no text is sorted by.
    """
    narrow = log.select(*keys, *order)
    last = narrow.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_last")).select(*keys, "_last.*")
    winners = stored(last.select(_mark(*keys, *order).alias("_mark")), "winners")
    marked = log.withColumn("_mark", _mark(*keys, *order))
    found = without_misses(marked, ["_mark"], bit_filter(winners, ["_mark"])).join(winners, "_mark")
    return found.dropDuplicates(["_mark"]).drop("_mark")


def _digest(*columns: str) -> Column:
    return F.md5(_mark(*columns))


def _tie(log: DataFrame) -> list[str]:
    """Which of lines with equal texts and times is read does not matter; one user's are fewer."""
    return ["user_id"] if "user_id" in log.columns else []


def dedup_exact(log: DataFrame, with_time: bool = True) -> DataFrame:
    """Distinct (id, publish time, content), or (id, content)."""
    keys = ["news_id", "publish_ts", "_digest"] if with_time else ["news_id", "_digest"]
    timed = log.withColumn("_digest", _digest("content"))
    if with_time:
        timed = timed.withColumn("publish_ts", parse_publish_time(F.col("publish_text")))
    return _one_line_each(timed, keys, ["click_ts", *_tie(log)]).select(*keys[:-1], "content")


def dedup_latest(log: DataFrame) -> DataFrame:
    """One row per article: that of its last click.

    Of lines of the same moment the one with the largest md5 of title, content
    and publish time counts.
    """
    marked = log.withColumn("_digest", _digest("title", "content", "publish_text"))
    return _one_line_each(marked, ["news_id"], ["click_ts", "_digest", *_tie(log)]).select(
        "news_id", "title", "content", "publish_text"
    )
