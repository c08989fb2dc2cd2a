"""Exact duplicates by refinement: length, prefix hash, full hash. Native only.

Texts are read once, into a narrow table of keys; they are never shuffled.
Each level reads one more column of that table, for the rows whose group
survived the level before. Groups are counted where their rows are before they
are shuffled, and rows are joined to their group with hot keys salted, so a
group may hold any part of all rows.

Null texts count as empty. Rows with a null doc_id count as the smallest of
their group. Of rows that repeat doc_id and text one stays. An empty table
gives an empty result.
"""

from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.common import whole_text, without_losers
from broadsheet.plans.skew import salted_join
from broadsheet.plans.storage import stored

PREFIX_CHARS = 64


def text_keys(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Per row: doc_id, a row number, length, prefix hash and full hash of its text."""
    text = whole_text()
    return docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("_row"),
        F.octet_length(text).alias("_length"),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("_prefix"),
        F.unhex(F.sha2(text, 256)).alias("_full"),
    )


def _survivors(keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows of groups of two or more, stored, as the next level reads them several times."""
    groups = keys.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    large = stored(groups, "large")
    return stored(salted_join(keys, large.select(*on), on, large, "_n", ["_row"]), "survivors")


def _judged(docs: DataFrame) -> DataFrame:
    """The keys of every row, with ``_n`` and ``_last`` (doc_id and row that stay) where its text has copies."""
    keys = stored(text_keys(docs), "textkeys")
    rows = _survivors(_survivors(keys, ["_length"]), ["_length", "_prefix"])
    level = ["_length", "_prefix", "_full"]
    groups = rows.groupBy(*level).agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("doc_id", "_row")).alias("_last"))
    copies = stored(groups.where("_n > 1"), "copies")
    return salted_join(keys, copies, level, copies, "_n", ["_row"], how="left")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Every row with its group: doc_id, keep_id, group_size, kept, text_sha256."""
    alone = F.col("_n").isNull()
    return _judged(docs).select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_last.doc_id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("_last._row"))).alias("kept"),
        F.lower(F.hex("_full")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Only texts of rows that lose are moved, and few others. Of rows alike in
    doc_id and text, one stays.
    """
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    last = F.col("doc_id").eqNullSafe(F.col("_last.doc_id"))
    keys = _judged(docs).where("_n > 1").groupBy(F.col("_full").alias("__k0"), number.alias("__k1")).agg(
        F.bool_or(last).alias("__stays"), F.count(F.lit(1)).alias("__rows")
    )
    verdict = stored(keys.where("NOT __stays OR __rows > 1").drop("__rows"), "verdict")
    return without_losers(docs, [F.unhex(F.sha2(whole_text(), 256)), number], verdict)
