"""Vocabulary and the article-term matrix, sparse first."""

from pyspark.sql import DataFrame, functions as F

from broadsheet.functions.text import glue_key
from broadsheet.functions.times import epoch_millis
from broadsheet.operators.keywords import doc_frequency
from broadsheet.plans.bitfilter import bit_filter, without_misses
from broadsheet.plans.skew import ranked, salted_join


def vocabulary(keywords: DataFrame) -> DataFrame:
    """All keywords, numbered from 0 in term order."""
    words = keywords.select("term").distinct()
    numbered = ranked(words, [(F.col("term"), "asc")], "position")
    return numbered.select("term", (F.col("position") - 1).alias("term_id"))


def extended_vocabulary(words: DataFrame, keywords: DataFrame) -> DataFrame:
    """The vocabulary with the new terms of ``keywords`` behind it; ids given once stay as they are.

    New terms are numbered in term order from after the largest id, over many
    tasks, so ids stay dense and a matrix made with the old ones stays right.
    """
    fresh = vocabulary(keywords.select("term").distinct().join(words, "term", "left_anti"))
    start = words.agg((F.coalesce(F.max("term_id"), F.lit(-1)) + 1).alias("start")).scalar()
    return words.select("term", "term_id").unionByName(fresh.withColumn("term_id", F.col("term_id") + start))


def known_terms(keywords: DataFrame, words: DataFrame) -> DataFrame:
    """Keywords that are in the vocabulary.

    Most of a new text's words may be none of it: a filter of the vocabulary
    rules them out where they are read, and only what may be known is shuffled.
    """
    terms = words.select("term")
    return _on_vocabulary(without_misses(keywords, ["term"], bit_filter(terms, ["term"])), terms)


def unknown_terms(keywords: DataFrame, words: DataFrame) -> DataFrame:
    """Keywords that are not in the vocabulary."""
    marked = words.select("term", F.lit(True).alias("known"))
    return _on_vocabulary(keywords, marked, "left").where("known IS NULL").drop("known")


def _on_vocabulary(keywords: DataFrame, words: DataFrame, how: str = "inner") -> DataFrame:
    return salted_join(keywords, words, "term", doc_frequency(keywords), "df", ["news_id"], how)


def doc_term_matrix(keywords: DataFrame, words: DataFrame) -> DataFrame:
    """Nonzero cells (article, term id, count) on the given vocabulary.

    With the vocabulary of the training articles this is also the matrix of
    new articles: their unknown terms have no column and fall away.
    """
    return _on_vocabulary(keywords, words).select("news_id", "term_id", "n")


def binary_matrix(matrix: DataFrame) -> DataFrame:
    """Cells that are exactly one."""
    return matrix.where("n = 1").select("news_id", "term_id", F.lit(1).alias("cell"))


def zero_filled(articles: DataFrame, matrix: DataFrame, words: DataFrame) -> DataFrame:
    """Every article as a vector over the whole vocabulary ``words``.

    ``width`` is the number of columns, ``indices`` and ``values`` are the
    cells that are not zero, by column; all others are zero and not written
    out. Articles without cells have none. An article has few cells, its
    keywords, so a row is short however many columns there are.
    """
    rows = matrix.groupBy("news_id").agg(
        F.array_sort(F.collect_list(F.struct("term_id", "n"))).alias("cells")
    )
    width = words.agg(F.count(F.lit(1)).alias("width")).scalar()
    none = F.expr("cast(array() as array<bigint>)")
    return articles.join(rows, "news_id", "left").select(
        *articles.columns,
        width.alias("width"),
        F.coalesce(F.col("cells.term_id"), none).alias("indices"),
        F.coalesce(F.col("cells.n"), none).alias("values"),
    )


def sparse_lines(articles: DataFrame, matrix: DataFrame, words: DataFrame, sep: str = " ") -> DataFrame:
    """The vectors as text: ``id|milliseconds``, the width, and ``column:count`` pairs."""
    key = glue_key(F.col("news_id"), epoch_millis(F.col("publish_ts")))
    pairs = F.zip_with("indices", "values", lambda i, n: F.concat_ws(":", i.cast("string"), n.cast("string")))
    filled = zero_filled(articles.select("news_id", "publish_ts"), matrix, words)
    line = F.concat_ws(sep, key, F.col("width").cast("string"), pairs)
    return filled.select("news_id", line.alias("line"))


def label_rows(labels: DataFrame, keywords: DataFrame) -> DataFrame:
    """Label and cells of each article in one text line; either may be missing.

    Cells are written sparse, ``term:count`` in term order.
    """
    rows = keywords.groupBy("news_id").agg(
        F.array_join(
            F.array_sort(F.collect_list(F.concat_ws(":", "term", F.col("n").cast("string")))), ","
        ).alias("cells")
    )
    joined = labels.join(rows, "news_id", "full_outer")
    label = F.coalesce(F.col("label").cast("string"), F.lit(""))
    return joined.select(
        "news_id", F.concat_ws(",", label, F.coalesce("cells", F.lit(""))).alias("line")
    )
