"""Session settings the jobs are written for."""

from pyspark.sql import SparkSession

PARTITIONS = "spark.sql.shuffle.partitions"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

SETTINGS = {
    # Times of a click log carry no zone; this keeps them as they are.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Before a job runs, Spark guesses sizes, and for exploded texts far too
    # low. So no table is sent to all executors on a guess: only on its
    # measured size, once it has been shuffled, or where the code has counted.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    # What a task reads of a shuffle takes some ten times the memory to sort, as
    # rows of terms pack well. Merged partitions stay this small however much
    # there is, so a task's memory does not grow with the tables.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # There must be enough of them to be merged: the same tables in the session's
    # own number of partitions, often one for each core, make a task as large as
    # its share of them. So a shuffle begins with this many, or the session's own.
    INITIAL: "1024",
    # If every partition of a join's smaller side was measured to be no larger
    # than that, it is hashed and the other side, which has a row per article
    # and term, is not sorted. Otherwise both are sorted, and may spill.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16MB",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    spark.conf.set(INITIAL, str(max(int(SETTINGS[INITIAL]), int(spark.conf.get(PARTITIONS)))))
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions a shuffle begins with, before small ones are merged."""
    merged = all(
        spark.conf.get(f"spark.sql.adaptive.{name}").lower() == "true" for name in ("enabled", "coalescePartitions.enabled")
    )
    own = spark.conf.get(PARTITIONS)
    return max(1, int(spark.conf.get(INITIAL, own) if merged else own))
