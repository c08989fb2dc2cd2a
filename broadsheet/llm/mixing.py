"""Mixing sources to target weights by a cut through a random order. Native only.

Every row has a hash-random key. Within a source, rows are in the order of that
key; a source gives all its rows as often as its target allows, and then the
rows before a cut where the words reach the target exactly. The order is range
partitioned by (source, key), so a large source lies over many tasks; words are
summed per task and source, the sums of a source are added up over its tasks,
and only the task that holds a source's cut is looked into. What the rows get
is then a comparison with the cut of their source.

Sizes are numbers of words; a null text has none. A null source is a source of
its own, the last. Rows of equal key, doc_id and size at the cut share what is
left evenly (rounded down). Rows without words are never taken. Targets of an
empty table, or of one without words, are 0.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.llm.common import count_words, whole_text
from broadsheet.plans.skew import ranked, salted_join
from broadsheet.plans.storage import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SENT_ROWS = 100_000  # cuts sent to all tasks
_PART_BITS = 33  # monotonically_increasing_id keeps the row number in these bits


def random_key(seed: str = "mix") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """The sources with ``target``, from their ``source_size`` and ``place`` (from 1).

    The total is shared by weight; targets stop at ``most`` times the source's
    size and the excess is shared again. Every round is one aggregate of one
    row, and stops at least one more source.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sources.withColumn("_weight", weight).withColumn("_most", F.col("source_size") * F.lit(float(most)))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while total:
        above = F.col("_most") <= F.col("_weight") * F.lit(level)
        full, free, now = weighed.agg(
            F.coalesce(F.sum(F.when(above, F.col("_most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0.0)),
            F.count(F.when(above, 1)),
        ).first()
        if now == stopped or not free:
            break
        stopped, level = now, (share * total - full) / free
    return weighed.withColumn(
        "target", F.round(F.least(F.col("_most"), F.col("_weight") * F.lit(level)), 6)
    ).drop("_weight", "_most")


def _sizes(docs: DataFrame, seed: str) -> DataFrame:
    return docs.select(
        "doc_id", "source", count_words(whole_text()).alias("size"), random_key(seed).alias("_key")
    )


def cuts(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """One row per source: source, source_size, rows, target, and where its order is cut.

    ``_times`` says how often all rows are taken. Rows before (_cut_key,
    _cut_id, _cut_size) are taken once more; rows at it give ``_cut_words``
    words each. Without a cut the key is null.
    """
    words = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    named = [(F.col("source").isNull(), "asc"), (F.col("source"), "asc")]
    aimed = targets(stored(ranked(words, named, "place"), "sources"), weights, share, most).drop("place")
    size = F.when(F.col("source_size") > 0, F.col("source_size"))
    times = F.coalesce(F.floor(F.floor("target") / size), F.lit(0))
    aimed = stored(
        aimed.withColumn("_times", times).withColumn(
            "_rest", F.floor("target") - F.col("_times") * F.col("source_size")
        ),
        "targets",
    )
    order = ["source", "_key", "doc_id", "size"]
    placed = stored(
        sizes.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*order, F.shiftright(F.monotonically_increasing_id(), _PART_BITS).alias("_part")),
        "order",
    )
    source = F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_name")
    placed = placed.select("*", *source)
    group = ["_none", "_name"]
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy(*group, "_part")
        .agg(F.sum("size").alias("_words"))
        .withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
        .join(aimed.select(*source, "_rest"), group)
        .where("_rest > _before AND _rest <= _before + _words")
    )
    # one part of each source at most, and of that only the rows of the source
    local = Window.partitionBy(*group).orderBy("_key", "doc_id", "size").rangeBetween(Window.unboundedPreceding, 0)
    alike = Window.partitionBy(*group, "_key", "doc_id", "size")
    cut = (
        placed.join(parts.select(*group, "_part", "_before", "_rest"), [*group, "_part"])
        .withColumn("_until", F.col("_before") + F.sum("size").over(local))
        .withColumn("_alike", F.count(F.lit(1)).over(alike))
        .where(F.col("_until") >= F.col("_rest"))
        .withColumn("_nth", F.row_number().over(Window.partitionBy(*group).orderBy("_key", "doc_id", "size")))
        .where("_nth = 1")
        .select(
            *group,
            F.col("_key").alias("_cut_key"),
            F.col("doc_id").alias("_cut_id"),
            F.col("size").alias("_cut_size"),
            F.floor((F.col("_rest") - F.col("_until") + F.col("_alike") * F.col("size")) / F.col("_alike")).alias("_cut_words"),
        )
    )
    return stored(aimed.select("*", *source).join(cut, group, "left"), "cuts")


def _taken(size: Column) -> Column:
    """Words taken of a row that is joined with the cut of its source."""
    mine = F.struct(F.col("_key").alias("a"), F.col("doc_id").alias("b"), size.alias("c"))
    cut = F.struct(F.col("_cut_key").alias("a"), F.col("_cut_id").alias("b"), F.col("_cut_size").alias("c"))
    last = (
        F.when(F.col("_cut_key").isNull(), F.lit(0))
        .when(mine < cut, size)
        .when(mine == cut, F.col("_cut_words"))
        .otherwise(F.lit(0))
    )
    return (F.col("_times") * size + last).cast("long")


def _with_cuts(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """Rows with the cut of their source.

    The stored cuts, a row per source, are counted: up to ``SENT_ROWS`` (some
    20 MB) they are sent to the rows, which then need not move; more of them are
    met by a shuffle, hot sources salted.
    """
    cut = by_source.drop("source")
    if by_source.count() <= SENT_ROWS:
        return rows.join(F.broadcast(cut), ["_none", "_name"])
    return salted_join(rows, cut, ["_none", "_name"], by_source, "rows", ["_key"])


def mixed(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = "mix"
) -> DataFrame:
    """Every row with what the mix takes: doc_id, size, source_size, target, taken."""
    sizes = stored(_sizes(docs, seed), "sizes")
    by_source = cuts(sizes, weights, share, most)
    source = F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_name")
    joined = _with_cuts(sizes.select("doc_id", "size", "_key", *source), by_source)
    return joined.select("doc_id", "size", "source_size", "target", _taken(F.col("size")).alias("taken"))


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = "mix"
) -> DataFrame:
    """The mixed documents: each row as often as it is taken, with all its columns.

    The row at the cut of its source has only its first words up to the cut
    when it is taken for the last time.
    """
    sizes = stored(_sizes(docs, seed), "sizes")
    by_source = cuts(sizes, weights, share, most)
    source = F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_name")
    full = docs.select(
        F.struct(*docs.columns).alias("_doc"), "doc_id", random_key(seed).alias("_key"),
        count_words(whole_text()).alias("_size"), *source,
    )
    joined = _with_cuts(full, by_source)
    left = F.col("_taken") - (F.col("_time") - 1) * F.col("_size")
    whole = (
        joined.withColumn("_taken", _taken(F.col("_size")))
        .where("_taken > 0")
        .withColumn("_time", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_taken") / F.col("_size")).cast("int"))))
        .withColumn("_left", left)
    )
    text = F.when(F.col("_left") >= F.col("_size"), F.col("_doc.text")).otherwise(first_words(F.col("_doc.text"), F.col("_left")))
    return whole.withColumn("_text", text).select(
        *[F.col("_text").alias(c) if c == "text" else F.col("_doc").getField(c).alias(c) for c in docs.columns]
    )


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words of a text, joined by one space."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), F.greatest(n, F.lit(0)).cast("int")), " ")
