"""TF-IDF: term counts, frequencies, keyword sets and the keyword dictionary.

Everything is kept in long form, one row per (article, term). Articles are
partitioned by id once, while they are still text; counting the terms of an
article then needs no further shuffle, and no table of a task's terms.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions.scores import inverse_frequency, rank_key, recover_count
from broadsheet.functions.text import keyword_hash, terms
from broadsheet.plans.skew import first_per_group, salted_join
from broadsheet.plans.storage import stored
from broadsheet.settings import BODY_TERMS, FIRST_TERMS, FREQUENCY_BUCKETS, RANK_DIGITS, TITLE_TERMS, TOP_TERMS


def _token_lists(articles: DataFrame, text: str, split) -> DataFrame:
    """The terms of each article, partitioned by article while still text."""
    texts = articles.select("news_id", text).repartition("news_id")
    return texts.select("news_id", split(F.col(text)).alias("tokens"))


def _token_rows(lists: DataFrame) -> DataFrame:
    # explode_outer: for explode, Spark would add a filter that evaluates the
    # pattern a second time, below the shuffle
    return lists.select(
        "news_id",
        F.size("tokens").cast("bigint").alias("n_terms"),
        F.explode_outer("tokens").alias("term"),
    ).where("term IS NOT NULL")


def tokenize(articles: DataFrame, text: str = "content", split=terms) -> DataFrame:
    """One row per term occurrence, with the number of terms of the article."""
    return _token_rows(_token_lists(articles, text, split))


def _of_article(ids: pa.ChunkedArray, last: pa.Scalar) -> pa.ChunkedArray:
    """Which rows are of the article ``last``."""
    return pc.equal(ids, last).fill_null(False) if last.is_valid else pc.is_null(ids)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences per (article, term) from tokens in the order of their articles.

    Only the article that a batch ends with is held, as it may go on in the next.
    """
    keys, held = ["news_id", "n_terms", "term"], None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]).append_column("n", pa.array(np.ones(batch.num_rows, np.int64)))
        rows = rows if held is None else pa.concat_tables([held, rows])
        counts = rows.group_by(keys, use_threads=False).aggregate([("n", "sum")]).select([*keys, "n_sum"])
        counts = counts.rename_columns([*keys, "n"])
        ends = _of_article(counts["news_id"], batch["news_id"][-1])
        held = counts.filter(ends)
        # groups come in no certain order; an article's rows are given one after the other
        yield from counts.filter(pc.invert(ends)).sort_by("news_id").to_batches()
    if held is not None:
        yield from held.to_batches()


def term_counts(articles: DataFrame, text: str = "content", split=terms) -> DataFrame:
    """Occurrences per (article, term), next to the article's length.

    Texts are sorted by article, so an article's terms come one after the other
    and are counted as they pass: a task holds the terms of one article and one
    batch, however many articles it has.
    """
    texts = articles.select("news_id", text).repartition("news_id").sortWithinPartitions("news_id")
    rows = _token_rows(texts.select("news_id", split(F.col(text)).alias("tokens")))
    news_id = articles.schema["news_id"].dataType.simpleString()
    return rows.mapInArrow(_counted, f"news_id {news_id}, n_terms long, term string, n long")


def doc_lengths(counts: DataFrame) -> DataFrame:
    return counts.groupBy("news_id").agg(F.sum("n").alias("n_terms"))


def doc_frequency(counts: DataFrame) -> DataFrame:
    """Number of articles each term occurs in."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def text_frequency(articles: DataFrame, text: str = "content", split=terms, dealt: bool = True) -> DataFrame:
    """:func:`doc_frequency` straight from texts with one row per article.

    Repeated terms are dropped inside the row, so no (article, term) table is
    built just to be counted. If texts are ``dealt`` by article, that is the
    exchange of :func:`term_counts`, for plans that have both.
    """
    once = F.array_distinct("tokens")
    lists = _token_lists(articles, text, split) if dealt else articles.select(split(F.col(text)).alias("tokens"))
    seen = lists.select(F.explode_outer(once).alias("term"))
    return doc_frequency(seen.where("term IS NOT NULL"))


def corpus_size(articles: DataFrame) -> Column:
    """Number of distinct articles, as a scalar subquery."""
    return articles.agg(F.count_distinct("news_id").alias("n_docs")).scalar()


def term_frequency(counts: DataFrame) -> DataFrame:
    return counts.withColumn("tf", F.col("n") / F.col("n_terms"))


def inverse_doc_frequency(df: DataFrame, n_docs: Column) -> DataFrame:
    return df.withColumn("idf", inverse_frequency(n_docs, F.col("df")))


def tfidf(
    counts: DataFrame,
    n_docs: Column,
    df: DataFrame | None = None,
    other_corpus: bool = False,
) -> DataFrame:
    """Weight of every (article, term).

    A frequent term is in a large part of all articles, so its rows are salted;
    the document frequencies themselves tell which terms these are. With the
    ``df`` of an ``other_corpus``, a term missing there counts as seen once.
    """
    df = doc_frequency(counts) if df is None else df
    weights = doc_frequency(counts) if other_corpus else df
    how = "left" if other_corpus else "inner"
    joined = salted_join(
        term_frequency(counts), df, "term", weights, "df", ["news_id"], how
    ).withColumn("df", F.coalesce("df", F.lit(1)))
    scored = inverse_doc_frequency(joined, n_docs)
    return scored.withColumn("tfidf", F.col("tf") * F.col("idf"))


def _frequency_bounds(df: DataFrame) -> np.ndarray:
    """Least and largest document frequency of the terms in each of ``FREQUENCY_BUCKETS`` buckets."""
    found = df.groupBy(_bucket().alias("at")).agg(F.min("df").alias("least"), F.max("df").alias("most")).toArrow()
    bounds = np.tile(np.array([[1], [np.iinfo(np.int32).max]], np.int32), FREQUENCY_BUCKETS)
    at = found["at"].to_numpy()
    for i, name in enumerate(("least", "most")):
        bounds[i, at] = np.minimum(found[name].to_numpy(), np.iinfo(np.int32).max)
    return bounds


def _bucket() -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(FREQUENCY_BUCKETS))


def contenders(counts: DataFrame, df: DataFrame, n_docs: Column, n: int) -> DataFrame:
    """The rows of :func:`term_counts` that may be among the ``n`` heaviest of their article.

    A table of fixed size bounds every term's frequency in ``df``, so each weight
    has a lower and an upper bound where it is counted. What stays below the n-th
    best lower bound of its article is dropped before the join with ``df``; the
    join decides among the rest, so the choice is exact.
    """
    bounds = counts.sparkSession.sparkContext.broadcast(_frequency_bounds(df))
    slack, names = 2 * 10.0**-RANK_DIGITS, counts.columns

    def chosen(rows: pa.Table) -> pa.Table:
        tf = rows["n"].to_numpy() / rows["n_terms"].to_numpy()
        least, most = bounds.value[:, rows["_bucket"].to_numpy()]
        docs = rows["_docs"].to_numpy()
        high, low = tf * np.log10(docs / least), tf * np.log10(docs / most)
        article = rows["news_id"].combine_chunks().dictionary_encode("encode").indices.to_numpy()
        order = np.lexsort((-low, article))
        start = np.searchsorted(article[order], np.arange(article.max() + 1))
        end = np.r_[start[1:], len(order)]
        floor = np.full(len(start), -np.inf)
        full = end - start >= n
        floor[full] = low[order[start[full] + n - 1]]
        return rows.filter(pa.array(high >= floor[article] - slack)).select(names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            ends = _of_article(rows["news_id"], batch["news_id"][-1])
            whole, held = rows.filter(pc.invert(ends)), rows.filter(ends)
            if whole.num_rows:
                yield from chosen(whole).to_batches()
        if held is not None:
            yield from chosen(held).to_batches()

    rows = counts.withColumn("_bucket", _bucket()).withColumn("_docs", n_docs.cast("double"))
    return rows.mapInArrow(task, counts.schema)


def article_tfidf(
    articles: DataFrame, text: str = "content", split=terms, n_docs: Column | None = None, first: int | None = None
) -> DataFrame:
    """TF-IDF of articles, one row each, against their own corpus.

    ``split`` cuts a text in terms. ``n_docs`` is a fixed corpus size; without
    it the articles are counted. Where only the ``first`` heaviest terms of an
    article are wanted, :func:`contenders` are all that is shuffled by term.
    """
    n_docs = corpus_size(articles) if n_docs is None else n_docs
    counts = term_counts(articles, text, split)
    if first is None:
        return tfidf(counts, n_docs, text_frequency(articles, text, split))
    df = stored(text_frequency(articles, text, split, dealt=False), "frequency")
    return tfidf(contenders(counts, df, n_docs, first), n_docs, df)


def top_keywords(scored: DataFrame, n: int = TOP_TERMS) -> DataFrame:
    """The ``n`` heaviest terms of every article, ties in term order."""
    return first_per_group(
        scored, ["news_id"], [(rank_key(F.col("tfidf")), "desc"), (F.col("term"), "asc")], n
    )


def first_keywords(scored: DataFrame, n: int = FIRST_TERMS) -> DataFrame:
    """A short keyword list; any would do, we take the heaviest."""
    return top_keywords(scored, n)


def recover_counts(scored: DataFrame) -> DataFrame:
    """The count behind tf, for tables that kept only tf and length."""
    return scored.withColumn("recovered", recover_count(F.col("tf"), F.col("n_terms")))


def title_body_keywords(
    articles: DataFrame, split=terms, n_docs: Column | None = None
) -> DataFrame:
    """Keywords of body and title together; weights of shared ones add up.

    Both use the frequencies of the bodies. Only positive weights make a
    keyword: a term in every article says nothing about any of them.
    """
    n_docs = corpus_size(articles) if n_docs is None else n_docs
    df = stored(text_frequency(articles, split=split, dealt=False), "frequency")
    counts = contenders(term_counts(articles, split=split), df, n_docs, BODY_TERMS)
    body = top_keywords(tfidf(counts, n_docs, df), BODY_TERMS)
    title_scores = tfidf(term_counts(articles, "title", split), n_docs, df, other_corpus=True)
    title = top_keywords(title_scores, TITLE_TERMS)
    both = body.select("news_id", "term", "tfidf").unionByName(
        title.select("news_id", "term", "tfidf")
    )
    return (
        both.where("tfidf > 0").groupBy("news_id", "term").agg(F.sum("tfidf").alias("weight"))
    )


def keyword_dictionary(keywords: DataFrame) -> DataFrame:
    """Every keyword once, with its hash."""
    return keywords.select(
        keyword_hash(F.col("term")).alias("term_hash"), F.trim("term").alias("term")
    ).distinct()


def hash_keywords(keywords: DataFrame) -> DataFrame:
    """Keywords replaced by their hash."""
    return keywords.select(
        "news_id", keyword_hash(F.col("term")).alias("term_hash"), "weight"
    )


def unhash_keywords(
    hashed: DataFrame, dictionary: DataFrame, spread_by: tuple[str, ...] = ("news_id",)
) -> DataFrame:
    """Hashes replaced by their keyword; rows of a hot one are dealt by ``spread_by``."""
    rows = hashed.groupBy("term_hash").agg(F.count(F.lit(1)).alias("rows"))
    return salted_join(hashed, dictionary, "term_hash", rows, "rows", spread_by)
