"""Connected components of a table of links, on Spark.

Large-star and small-star steps in turn: every node's larger neighbours are
hung on the smallest node it sees, then its smaller ones. Links only shrink
towards stars, and rounds end when all are stars. The smallest neighbour comes from an aggregate
that is combined before its shuffle, and links of a node with very many are
dealt over salts. Each round is a written table, which cuts the lineage.

Rounds shuffle over as many partitions as the counted links fill, not over the
session's number: that one fits texts, of which links are a small part.
"""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.plans.skew import salted_join
from broadsheet.plans.storage import stored

PART_LINKS = 500_000  # links of a shuffle partition, about 10 MB
LEAST_PARTS = 8


@contextmanager
def _shuffles_of(spark: SparkSession, links: int) -> Iterator[None]:
    """Shuffle partitions for so many links; the session's own number comes back after."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, max(LEAST_PARTS, -(-links // PART_LINKS)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _least(links: DataFrame) -> DataFrame:
    """Per node ``a`` its smallest neighbour or itself, and the number of links."""
    return links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("_least"), F.count(F.lit(1)).alias("_n"))


def _hang(links: DataFrame, kept: DataFrame) -> DataFrame:
    """Each ``b`` of ``kept`` linked with the smallest node that its ``a`` sees in ``links``."""
    least = stored(_least(links), "least")
    hung = salted_join(kept, least.select("a", "_least"), "a", least, "_n", ["b"])
    return hung.select(F.col("b").alias("a"), F.col("_least").alias("b")).where("a <> b")


def _flat(links: DataFrame) -> bool:
    """Whether every node hangs on one other only, which hangs on none."""
    ends = links.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("a"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("a").agg((F.sum("up") + F.max("down")).alias("ends"))
    return nodes.agg(F.count_if(F.col("ends") > 1)).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node in ``links`` (a, b)."""
    links = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    with _shuffles_of(links.sparkSession, links.count()):
        while not _flat(links):
            both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            large = stored(_hang(both, both.where("b > a")).distinct(), "links")
            # small star: a > b in every link now; the node itself hangs on the smallest too
            own = _least(large).select("a", F.col("_least").alias("b"))
            links = stored(_hang(large, large).unionByName(own).where("a <> b").distinct(), "links")
    tops = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        tops.select("node", F.col("node").alias("component"))
    )
