import numpy as np
import xxhash
from pyspark.sql import functions as F

from broadsheet.operators import matrix
from broadsheet.plans import bitfilter
from broadsheet.plans.skew import running_sums


def test_filter_never_rules_out_a_member(spark):
    members = spark.range(0, 3000, 3).select(F.concat(F.lit("é"), F.col("id").cast("string")).alias("key"))
    all_keys = spark.range(9000).select(F.concat(F.lit("é"), F.col("id").cast("string")).alias("key"))
    made = bitfilter.bit_filter(members, ["key"])
    tested = bitfilter.maybe_in(all_keys, ["key"], made, "maybe")
    found = {r["key"] for r in tested.where("maybe").collect()}
    assert found >= {f"é{i}" for i in range(0, 3000, 3)} and len(found) < 1010
    packed = bitfilter.packed(made)
    hashes = np.array([xxhash.xxh64_intdigest(f"é{i}".encode(), 42) for i in range(9000)], np.uint64).view(np.int64)
    assert {f"é{i}" for i in np.flatnonzero(bitfilter.hits(packed, hashes)).tolist()} == found
    plan = bitfilter.without_misses(all_keys, ["key"], made)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    small = bitfilter.bit_filter(members, ["key"], 1 << 15)  # one bitmap only
    assert bitfilter.without_misses(members, ["key"], small, 1 << 15).count() == 1000


def test_filter_of_an_empty_table(spark):
    none = bitfilter.bit_filter(spark.range(0), ["id"])
    assert bitfilter.without_misses(spark.range(10), ["id"], none).count() == 0
    assert not bitfilter.hits(bitfilter.packed(none), np.arange(5)).any()


def test_running_sums_of_large_and_small_groups(spark):
    rows = [("hot", i, i % 7) for i in range(4000)] + [("b", i, 1) for i in range(3)] + [(f"k{i}", 0, i) for i in range(500)]
    frame = spark.createDataFrame(rows, "g string, at long, v long").repartition(7)
    found = {(r.g, r.at): r.v for r in running_sums(frame, ["g"], [(F.col("at"), "asc")], ["v"]).collect()}
    back = {(r.g, r.at): r.v for r in running_sums(frame, ["g"], [(F.col("at"), "desc")], ["v"]).collect()}
    total, expected, totals = {}, {}, {}
    for g, at, v in rows:
        total[g] = total.get(g, 0) + v
        expected[g, at] = total[g]
    assert found == expected
    assert back == {(g, at): total[g] - expected[g, at] + v for g, at, v in rows}
    assert running_sums(frame.limit(0), ["g"], [(F.col("at"), "asc")], ["v"]).count() == 0


def test_unknown_terms_are_ruled_out_before_the_shuffle(spark):
    words = spark.range(20).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("term"))
    keywords = spark.range(20_000).select(
        (F.col("id") % 50).alias("news_id"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("term"), F.lit(1).alias("n")
    )
    known = matrix.known_terms(keywords, words)
    assert sorted(r["term"] for r in known.collect()) == sorted(f"w{i}" for i in range(20))
    plan = known._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("_bits") if "SortMergeJoin" in plan else "_bits" in plan
    left = bitfilter.without_misses(keywords, ["term"], bitfilter.bit_filter(words, ["term"]))
    assert 20 <= left.count() < 40  # of 20,000 rows that would be shuffled
