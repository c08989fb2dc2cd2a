"""Joins and rankings that hold when one key has a large part of all rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.plans.session import shuffle_partitions
from broadsheet.plans.storage import stored

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in these bits


def hot_keys(weights: DataFrame, on: Sequence[str], weight: str, parts: int) -> DataFrame:
    """Keys that hold more than one of ``parts`` equal parts of the total weight.

    ``_salts`` says how many parts' worth of rows a key has. There are fewer
    than ``parts`` such keys, so they may be broadcast.
    """
    part = weights.agg((F.sum(weight) / parts).alias("part")).scalar()
    sized = weights.select(*on, F.ceil(F.col(weight) / part).cast("int").alias("_salts"))
    return sized.where("_salts > 1")


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    weights: DataFrame,
    weight: str,
    spread_by: Sequence[str],
    how: str = "inner",
    widens: bool = False,
) -> DataFrame:
    """``facts`` ⋈ ``dim`` with the facts of hot keys spread over many tasks.

    ``weights`` says how many fact rows each key has. A key with more rows than
    an even share of one shuffle partition is dealt over as many salts as it
    fills partitions, by a hash of ``spread_by`` (not at random, so a lost task
    recomputes the same rows); its ``dim`` rows are repeated once per salt. All
    salts together are at most twice the partitions. ``how`` may be inner or
    left. ``widens`` says that a fact row meets many ``dim`` rows: all shuffle
    partitions are then kept, where Spark would merge them by the size of what
    goes in, small against what comes out.
    """
    on = [on] if isinstance(on, str) else list(on)
    parts = shuffle_partitions(facts.sparkSession)
    hot = F.broadcast(hot_keys(weights, on, weight, parts))
    salts = F.coalesce("_salts", F.lit(1))
    dealt = facts.join(hot, on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), salts).cast("int")
    )
    if widens:
        dealt = dealt.repartition(parts, *on, "_salt")
    repeated = dim.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    return dealt.drop("_salts").join(repeated.drop("_salts"), [*on, "_salt"], how).drop("_salt")


def two_sided_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], spread_left: Sequence[str], spread_right: Sequence[str]
) -> DataFrame:
    """``left`` ⋈ ``right`` where keys may have very many rows on both sides.

    A key's weight is the number of joined rows it makes, left times right. One
    with more than an even share of a shuffle partition is dealt over a grid:
    its left rows over the grid's rows, by a hash of ``spread_left``, each
    repeated once per column; its right rows over the columns, each repeated
    once per row. Every pair meets in one cell, and the grid is as long on a
    side as that side is heavy, so few rows are repeated. Cells together are a
    small multiple of the partitions.
    """
    on = [on] if isinstance(on, str) else list(on)
    parts = max(1, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = F.count(F.lit(1)).cast("double")
    weights = left.groupBy(*on).agg(rows.alias("_l")).join(right.groupBy(*on).agg(rows.alias("_r")), on)
    weights = stored(weights.withColumn("_made", F.col("_l") * F.col("_r")), "weights")
    cells = hot_keys(weights, on, "_made", parts).join(weights, on)
    down = F.least("_salts", F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("_salts") * F.col("_l") / F.col("_r"))))).cast("int")
    grid = cells.select(*on, "_salts", down.alias("_down")).select(
        *on, "_down", F.ceil(F.col("_salts") / F.col("_down")).cast("int").alias("_across")
    )
    grid = F.broadcast(stored(grid, "grid"))
    down, across = (F.coalesce(c, F.lit(1)) for c in ("_down", "_across"))

    def dealt(side: DataFrame, own: str, n: Column, spread: Sequence[str], other: str, m: Column) -> DataFrame:
        placed = side.join(grid, on, "left").withColumn(own, F.pmod(F.xxhash64(*spread), n).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), m - 1))).drop("_down", "_across")

    rows_of = dealt(left, "_row", down, spread_left, "_column", across).repartition(parts, *on, "_row", "_column")
    columns_of = dealt(right, "_column", across, spread_right, "_row", down)
    return rows_of.join(columns_of, [*on, "_row", "_column"]).drop("_row", "_column")


def ranked(
    frame: DataFrame,
    order_by: Sequence[tuple[Column, str]],
    name: str,
    within: Sequence[str] = (),
) -> DataFrame:
    """Number all rows from 1 in the given order, within each ``within`` group.

    ``order_by`` pairs columns with "asc" or "desc" and must order the rows of
    a group totally. Rows are range partitioned and sorted, so a group larger
    than a task spreads over several; it is numbered in each and shifted by the
    rows before. The sorted rows are stored first, since range bounds come from
    a sample and the parts must not differ between the two passes.
    """
    # keys as columns: a sort would work expressions out at every comparison
    keyed = frame.select("*", *[c.alias(f"_key{i}") for i, (c, _) in enumerate(order_by)])
    order = [F.col(c) for c in within] + [
        F.desc(f"_key{i}") if way == "desc" else F.asc(f"_key{i}")
        for i, (_, way) in enumerate(order_by)
    ]
    placed = (
        keyed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*frame.columns, F.monotonically_increasing_id().alias("_at"))
    )
    placed = stored(placed).withColumn("_part", F.shiftright("_at", _LOCAL_BITS))
    group = ["_part", *within]
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # one row per group and part; only the first group of a part can have begun
    # in an earlier one, so what is left after the filter is one row per part
    carried = (
        placed.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_carried", F.sum("_rows").over(before))
        .where("_carried > 0")
        .drop("_rows")
    )
    carried = carried.select("_carried", *[F.col(c).alias(f"_of_{c}") for c in group])
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group]  # a null is a group like others
    first = F.min("_at").over(Window.partitionBy(*group))
    return (
        placed.withColumn("_local", F.col("_at") - first)
        .join(F.broadcast(carried), same, "left")
        .withColumn(name, F.col("_local") + 1 + F.coalesce("_carried", F.lit(0)))
        .drop("_at", "_part", "_local", "_carried", *[f"_of_{c}" for c in group])
    )


def running_sums(
    frame: DataFrame, within: Sequence[str], order_by: Sequence[tuple[Column, str]], sums: Sequence[str]
) -> DataFrame:
    """Replace each column of ``sums`` by its running sum, the row's own value included.

    Like :func:`ranked`, a group of any size may lie over many tasks: sums run
    within each task's part of a group and are shifted by what the parts before
    hold. ``order_by`` must order the rows of a group totally.
    """
    keyed = frame.select("*", *[c.alias(f"_key{i}") for i, (c, _) in enumerate(order_by)])
    names = [f"_key{i}" for i in range(len(order_by))]
    order = [F.col(c) for c in within] + [
        F.desc(n) if way == "desc" else F.asc(n) for n, (_, way) in zip(names, order_by)
    ]
    placed = stored(
        keyed.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_part")), "runs"
    )
    group = ["_part", *within]
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy(*group).agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    # only the first group of a part can have begun in an earlier one
    carried = carried.select(
        *group,
        F.count(F.lit(1)).over(before).alias("_earlier"),
        *[F.sum(f"_sum_{c}").over(before).alias(f"_sum_{c}") for c in sums],
    ).where("_earlier > 0")
    local = Window.partitionBy(*group).orderBy(*order[len(within) :]).rowsBetween(Window.unboundedPreceding, 0)
    run = placed.select(
        *group, *[c for c in frame.columns if c not in sums and c not in within], *[F.sum(c).over(local).alias(c) for c in sums]
    )
    shifted = run.join(F.broadcast(carried), group, "left")
    return shifted.select(
        *[(F.col(c) + F.coalesce(f"_sum_{c}", F.lit(0))).alias(c) if c in sums else F.col(c) for c in frame.columns]
    )


def first_per_group(
    frame: DataFrame,
    by: Sequence[str],
    order_by: Sequence[tuple[Column, str]],
    n: int,
    name: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark cuts every group to ``n`` rows per task before it shuffles, so a
    large group never meets in one place.
    """
    order = [c.desc() if way == "desc" else c.asc() for c, way in order_by]
    window = Window.partitionBy(*by).orderBy(*order)
    return frame.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
