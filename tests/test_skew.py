"""Joins and rankings with a key that holds most rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from broadsheet.plans.skew import first_per_group, hot_keys, ranked, salted_join, two_sided_join
from broadsheet.plans.storage import shared_folder, stored


@pytest.fixture
def skewed(spark):
    """3,000 rows: one key with two thirds, 500 with two rows each."""
    hot = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    cold = spark.range(1000).select(
        F.concat(F.lit("c"), (F.col("id") % 500).cast("string")).alias("k"),
        (F.col("id") + 2000).alias("v"),
    )
    return hot.unionByName(cold)


def sizes(df):
    return df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def test_only_keys_above_one_partition_are_hot(skewed):
    found = hot_keys(sizes(skewed), ["k"], "n", 8).collect()
    assert [(r["k"], r["_salts"]) for r in found] == [("hot", 6)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("widens", [False, True])
def test_salted_join_equals_plain_join(skewed, how, widens):
    dim = sizes(skewed).where("k <> 'c7'").withColumn("w", F.length("k"))
    dim = dim.unionByName(dim.withColumn("w", F.lit(-1)))  # two rows per key
    got = salted_join(
        skewed, dim.select("k", "w"), "k", sizes(skewed), "n", ["v"], how, widens
    )
    want = skewed.join(dim.select("k", "w"), "k", how)
    assert Counter(map(tuple, got.select("k", "v", "w").collect())) == Counter(
        map(tuple, want.select("k", "v", "w").collect())
    )


def test_hot_rows_are_dealt_over_several_tasks(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(skewed, sizes(skewed), "k", sizes(skewed), "n", ["v"])
        tasks = joined.where("k = 'hot'").select(F.spark_partition_id().alias("p"))
        assert tasks.distinct().count() > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranked_numbers_all_rows_in_order(skewed):
    got = ranked(skewed.select("v"), [(F.col("v"), "desc")], "rank").collect()
    assert sorted((r["rank"], r["v"]) for r in got) == [(i + 1, 2999 - i) for i in range(3000)]


def test_ranked_numbers_within_groups_larger_than_a_task(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranked(skewed, [(F.col("v"), "desc")], "rank", ["k"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by_key = {}
    for r in got:
        by_key.setdefault(r["k"], []).append((r["rank"], r["v"]))
    assert len(got) == 3000
    for pairs in by_key.values():
        values = sorted((v for _, v in pairs), reverse=True)
        assert sorted(pairs) == [(i + 1, v) for i, v in enumerate(values)]


def test_first_per_group(skewed):
    got = first_per_group(skewed, ["k"], [(F.col("v"), "asc")], 3)
    hot = sorted((r["rank"], r["v"]) for r in got.where("k = 'hot'").collect())
    assert hot == [(1, 0), (2, 1), (3, 2)]
    assert got.where("k = 'c0'").count() == 2


def test_groups_are_cut_before_the_shuffle(spark, skewed):
    plan = first_per_group(skewed, ["k"], [(F.col("v"), "asc")], 3)._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.index("Final") < physical.index("Exchange hashpartitioning(k")
    assert physical.index("Partial") > physical.index("Exchange hashpartitioning(k")


def test_stored_reads_back_from_the_shared_folder(spark, skewed):
    table = stored(skewed)
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert all(folder in name for name in table.inputFiles())
    assert table.count() == 3000


def test_keys_heavy_on_both_sides(spark):
    """A key of 10^3 x 10^3 rows and one of 3 x 10^4, among small ones: pairs over all tasks."""
    def side(name, hot, wide):
        cold = spark.range(400).select(F.concat(F.lit("c"), (F.col("id") % 200).cast("string")).alias("k"), F.col("id").alias(name))
        for key, n in (("hot", hot), ("wide", wide), (name, 50)):  # the last has no partner
            cold = cold.unionByName(spark.range(n).select(F.lit(key).alias("k"), (F.col("id") + 10**6).alias(name)))
        return cold

    left, right = side("l", 1000, 3), side("r", 1000, 10_000)
    settings = {"adaptive.coalescePartitions.enabled": "false", "adaptive.autoBroadcastJoinThreshold": "-1", "autoBroadcastJoinThreshold": "-1", "shuffle.partitions": "32"}
    for name, value in settings.items():
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        joined = two_sided_join(left, right, "k", ["l"], ["r"])
        assert sorted(joined.columns) == ["k", "l", "r"]
        want = left.join(right, "k")
        fold = [F.count(F.lit(1)), F.sum(F.xxhash64("k", "l", "r") % 1000)]
        assert joined.agg(*fold).first() == want.agg(*fold).first()
        assert joined.distinct().count() == 1000 * 1000 + 3 * 10_000 + 800
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) > 16 and max(per_task) < sum(per_task) / 6
    finally:
        for name in settings:
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    none = left.limit(0)
    assert two_sided_join(none, right, "k", ["l"], ["r"]).count() == 0
