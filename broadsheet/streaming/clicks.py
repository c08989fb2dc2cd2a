"""The same profiles, kept up to date from a stream of clicks.

There is no state to hold: the profile is a table written as a log. Each
micro-batch adds the changes its clicks make, worked out like a batch of its
own (clicks counted per user and article, hot articles dealt over tasks). Now
and then the changes are merged with the last snapshot into a new one, so a
reader takes one snapshot and the few changes since. A batch that is replayed
after a failure replaces its changes.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet.functions.scores import decay
from broadsheet.functions.times import hour_slot, hours_between
from broadsheet.operators import profiles
from broadsheet.plans.storage import fresh_path
from broadsheet.settings import HALF_LIFE_HOURS, SLOT_HOURS

MERGE_EVERY = 10  # micro-batches between snapshots


@dataclass(frozen=True)
class Running:
    """A table kept by a stream: the change of a batch of clicks, and how changes are put together.

    ``once`` says that a change, and what changes are merged to, has every key once.
    """

    change: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    once: bool = False


def _sums(keys: list[str], value: str) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.groupBy(*keys).agg(F.sum(value).alias(value))


def running_profile(keywords: DataFrame) -> Running:
    """Weight of each (user, keyword)."""
    return Running(lambda clicks: profiles.keyword_profile(clicks, keywords), _sums(["user_id", "term"], "weight"), once=True)


def running_categories(assignment: DataFrame) -> Running:
    """Clicks per (user, category); the clicks carry ``publish_ts``."""
    return Running(
        lambda clicks: profiles.user_category_counts(clicks, assignment), _sums(["user_id", "category"], "clicks"), once=True
    )


def running_decay(keywords: DataFrame, half_life_hours: float = HALF_LIFE_HOURS) -> Running:
    """Weight with half-life of each (user, keyword), as it was at ``seen``.

    Weights are kept as of the newest click of their batch; merged, as of the
    newest of all. They are only ever scaled down, so nothing overflows however
    long the stream runs. :func:`decay_to` ages them when they are read.
    """

    def change(clicks: DataFrame) -> DataFrame:
        newest = clicks.agg(F.max("click_ts")).scalar()
        return profiles.decayed_profile(clicks, keywords, newest, half_life_hours).withColumn("seen", newest)

    def merge(rows: DataFrame) -> DataFrame:
        newest = rows.agg(F.max("seen")).scalar()
        aged = F.col("weight") * decay(hours_between(F.col("seen"), F.col("_newest")), half_life_hours)
        summed = rows.withColumn("_newest", newest).groupBy("user_id", "term").agg(F.sum(aged).alias("weight"))
        return summed.withColumn("seen", newest)

    return Running(change, merge, once=True)


def decay_to(profile: DataFrame, as_of: Column, half_life_hours: float = HALF_LIFE_HOURS) -> DataFrame:
    """A profile with half-life as it is at ``as_of``."""
    aged = decay(hours_between(F.col("seen"), as_of), half_life_hours)
    return profile.withColumn("weight", F.col("weight") * aged).drop("seen")


def daily_click_stream(
    clicks: DataFrame, late: str = "1 hour", slot_hours: int = SLOT_HOURS
) -> DataFrame:
    """Clicks per day and time slot; a day is given out once it is over.

    Clicks that come more than ``late`` behind the newest are left out.
    """
    timed = clicks.withColumn("event_time", F.col("click_ts").cast("timestamp"))
    counted = (
        timed.withWatermark("event_time", late)
        .groupBy(
            F.window("event_time", "1 day"),
            hour_slot(F.col("event_time"), slot_hours).alias("slot"),
        )
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    return counted.select(F.to_date("window.start").alias("day"), "slot", "clicks")


# --- running a stream ---------------------------------------------------------------


def record(running: Running, table: str, clicks: DataFrame, epoch: int, merge_every: int = MERGE_EVERY) -> None:
    """Write the changes of one batch; every ``merge_every`` batches also a snapshot.

    A snapshot counts once its mark is written, which comes last.
    """
    running.change(clicks).write.mode("overwrite").parquet(f"{table}/changes/epoch={epoch}")
    if (epoch + 1) % merge_every == 0:
        spark = clicks.sparkSession
        latest(spark, table, running).write.mode("overwrite").parquet(f"{table}/merged/upto={epoch}")
        _mark(spark, table, [(epoch,)])


def _mark(spark: SparkSession, table: str, epochs: list[tuple[int]]) -> None:
    spark.createDataFrame(epochs, "upto long").coalesce(1).write.mode("append").parquet(f"{table}/marks")


def latest(spark: SparkSession, table: str, running: Running) -> DataFrame:
    """The table as it is: the last snapshot and the changes since."""
    upto = spark.read.schema("upto long").parquet(f"{table}/marks").agg(F.max("upto")).first()[0]
    changes = spark.read.option("basePath", f"{table}/changes").parquet(f"{table}/changes")
    rows = changes if upto is None else changes.where(F.col("epoch") > upto)
    # of one batch, or a snapshot without later changes, there is nothing to put together
    alone = running.once and len(rows.select("epoch").distinct().take(2)) + (upto is not None) < 2
    rows = rows.drop("epoch")
    if upto is not None:
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{table}/merged/upto={upto}"))
    return rows if alone else running.merge(rows)


def start_updates(
    clicks: DataFrame, running: Running, table: str, checkpoint: str, merge_every: int = MERGE_EVERY, **trigger: object
) -> StreamingQuery:
    """Record the changes of every micro-batch of clicks under ``table``."""
    spark = clicks.sparkSession
    # so that there is a table to read before the first click; no batch has this number
    running.change(spark.createDataFrame([], clicks.schema)).write.mode("overwrite").parquet(f"{table}/changes/epoch=-1")
    _mark(spark, table, [])
    return (
        clicks.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, epoch: record(running, table, batch, epoch, merge_every))
        .trigger(**trigger)
        .start()
    )


def start_append(
    finished: DataFrame, table: str, checkpoint: str, **trigger: object
) -> StreamingQuery:
    """Append rows that are final."""
    return (
        finished.writeStream.outputMode("append")
        .format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_updates(clicks: DataFrame, running: Running) -> DataFrame:
    """Take all input there is, then return the table."""
    spark = clicks.sparkSession
    table, checkpoint = fresh_path(spark, "updates"), fresh_path(spark, "state")
    start_updates(clicks, running, table, checkpoint, availableNow=True).awaitTermination()
    return latest(spark, table, running)


def run_append(finished: DataFrame) -> DataFrame:
    """Take all input there is, then return the rows that are final."""
    spark = finished.sparkSession
    table, checkpoint = fresh_path(spark, "final"), fresh_path(spark, "state")
    spark.createDataFrame([], finished.schema).write.parquet(table)  # the stream may be empty
    start_append(finished, table, checkpoint, availableNow=True).awaitTermination()
    return spark.read.schema(finished.schema).parquet(table)
