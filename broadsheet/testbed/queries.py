"""One query per operator, over the whole test tables."""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.functions import text as text_functions
from broadsheet.functions.scores import share_text
from broadsheet.functions.times import epoch_millis
from broadsheet.operators import articles, bayes, clusters, keywords, matrix, profiles, ranking
from broadsheet.plans.session import prepare
from broadsheet.plans.storage import fresh_path, stored
from broadsheet.settings import FIRST_TERMS, PROFILE_PARTS, TOP_TERMS
from broadsheet.sources import tables
from broadsheet.streaming import clicks as streams
from broadsheet.testbed import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def prepared(spark: SparkSession, sf: str) -> DataFrame:
        return function(prepare(spark), sf)

    QUERIES[function.__name__] = prepared
    return function


def r6(column: str | Column, name: str | None = None) -> Column:
    name = column if name is None else name
    return F.round(F.col(column) if isinstance(column, str) else column, 6).alias(name)


# --- shared pieces ----------------------------------------------------------------


def _counts(spark, sf):
    return keywords.term_counts(views.news(spark, sf))


def _scored(spark, sf, first=None):
    return keywords.article_tfidf(views.news(spark, sf), first=first)


def _top(spark, sf):
    return keywords.top_keywords(_scored(spark, sf))


def _stored_top(spark, sf):
    top = keywords.top_keywords(_scored(spark, sf, TOP_TERMS)).select("news_id", "term", "n")
    return stored(top, "top-keywords")


def _stored_tags(spark, sf):
    return stored(keywords.title_body_keywords(views.news(spark, sf)), "tags")


def _profile(spark, sf, tags=None, parts=None):
    tags = _stored_tags(spark, sf) if tags is None else tags
    return profiles.keyword_profile(views.clicks(spark, sf), tags, parts)


def _stored_profile(spark, sf, tags=None):
    return stored(_profile(spark, sf, tags), "profile")


def _profile_and_tags(spark, sf):
    tags = _stored_tags(spark, sf)
    return _stored_profile(spark, sf, tags), tags


def _overlap_lists(spark, sf, read=None):
    """Lists of all readers over all articles, also those without keywords."""
    return ranking.recommend_by_overlap(
        *_profile_and_tags(spark, sf), read=read, articles=views.news(spark, sf), users=views.clicks(spark, sf)
    )


def _category_counts(spark, sf):
    return profiles.user_category_counts(
        views.timed_clicks(spark, sf), views.assignment(spark, sf)
    )


def _shares(spark, sf):
    return profiles.user_category_share(_category_counts(spark, sf)).select(
        "user_id", "category", "share"
    )


def _stored_shares(spark, sf):
    return stored(_shares(spark, sf), "shares")


def _gravity(spark, sf):
    return ranking.gravity_scores(views.assignment(spark, sf), views.as_of())


def _train_cells(spark, sf):
    top = keywords.top_keywords(keywords.article_tfidf(views.train_news(spark, sf)))
    cells = bayes.labelled_cells(top.select("news_id", "term", "n"), views.labels(spark, sf))
    return stored(cells, "train-cells")


def _new_cells(spark, sf):
    top = keywords.top_keywords(keywords.article_tfidf(views.new_news(spark, sf)))
    return stored(top.select("news_id", "term", "n"), "new-cells")


def _model(cells, labels):
    return (
        stored(bayes.term_table(cells, labels), "terms"),
        stored(bayes.label_table(cells, labels), "classes"),
    )


def _classified(spark, sf):
    """New articles with their class, by a model of the labelled ones."""
    terms, classes = _model(_train_cells(spark, sf), views.labels(spark, sf))
    return bayes.predict(views.new_news(spark, sf), _new_cells(spark, sf), terms, classes)


def _stored_gravity(spark, sf):
    return stored(_gravity(spark, sf), "gravity")


# --- sources and sinks --------------------------------------------------------------


@query
def read_click_log(spark, sf):
    path = fresh_path(spark, "click-log")
    tables.write_click_log(views.raw_log(spark, sf), path)
    return tables.read_click_log(spark, path)


@query
def read_brief_log(spark, sf):
    path = fresh_path(spark, "brief-log")
    tables.write_brief_log(articles.brief_clicks(views.raw_log(spark, sf)), path)
    return tables.read_brief_log(spark, path)


@query
def read_assignments(spark, sf):
    path = fresh_path(spark, "assignments")
    tables.write_assignments(views.assignment(spark, sf), path)
    return tables.read_assignments(spark, path)


@query
def read_keyword_map(spark, sf):
    path = fresh_path(spark, "keyword-map")
    tables.write_keyword_map(_stored_tags(spark, sf), views.news(spark, sf), path)
    return tables.read_keyword_map(spark, path).select("news_id", "term", r6("weight"))


@query
def write_keyword_map(spark, sf):
    return tables.keyword_lines(_stored_tags(spark, sf), digits=6)


def _labelled_table(spark, sf):
    documents = views.table(spark, sf, "documents").withColumnRenamed("doc_id", "news_id")
    return documents.select("news_id", "lang", "source", "n_chars")


def _labelled_rows(spark, sf):
    path = fresh_path(spark, "labelled")
    rows = _labelled_table(spark, sf).join(views.labels(spark, sf), "news_id")
    tables.write_labelled_csv(rows.select("label", "lang", "source", "n_chars"), path)
    return tables.read_labelled_csv(spark, path)


@query
def read_labelled_csv(spark, sf):
    cells = tables.cell_rows(_labelled_rows(spark, sf))
    return cells.groupBy("label", "position", "cell").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def cell_index(spark, sf):
    seen = tables.cell_dictionary(tables.cell_rows(_labelled_rows(spark, sf)))
    fresh = _labelled_table(spark, sf).join(views.labels(spark, sf), "news_id", "left_anti")
    cells = tables.cell_rows(
        fresh.select("news_id", F.array("lang", "source", F.col("n_chars").cast("string")).alias("cells"))
    )
    return tables.index_cells(cells, seen, ["news_id", "position"])


@query
def union_tagged_sources(spark, sf):
    clicked = views.timed_clicks(spark, sf).select("news_id", "publish_ts", "user_id")
    assigned = views.assignment(spark, sf)
    union = tables.tagged_union({"clicks": clicked, "assignments": assigned})
    return union.groupBy("source", "news_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("user_id").alias("n_users"),
        F.count("category").alias("n_categories"),
    )


@query
def write_table(spark, sf):
    """A table written over another."""
    documents = views.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    path = fresh_path(spark, "table")
    tables.write_table(documents.where("lang IS NOT NULL"), path)
    tables.write_table(documents, path)
    return spark.read.parquet(path)


@query
def save_state(spark, sf):
    """Two tables of a model, kept and loaded."""
    folder = fresh_path(spark, "model")
    tables.save_state({"assignment": views.assignment(spark, sf), "labels": views.labels(spark, sf)}, folder)
    kept = tables.load_state(spark, folder, ["assignment", "labels"])
    kinds = [kept["assignment"].withColumnRenamed("category", "value"), kept["labels"].withColumnRenamed("label", "value")]
    named = tables.tagged_union({"assignment": kinds[0], "labels": kinds[1]})
    return named.select("source", "news_id", F.col("value").cast("bigint").alias("value"))


# --- projections and filters ----------------------------------------------------------


@query
def brief_clicks(spark, sf):
    return articles.brief_clicks(views.raw_log(spark, sf))


@query
def user_news_map(spark, sf):
    return articles.user_news_map(views.raw_log(spark, sf))


@query
def nonzero_preferences(spark, sf):
    wide = profiles.preference_matrix(_shares(spark, sf))
    return profiles.nonzero_preferences(wide).select("user_id", "category", r6("share"))


@query
def category_membership(spark, sf):
    assigned = views.assignment(spark, sf)
    return ranking.in_preferred_categories(assigned, _shares(spark, sf)).select(
        "news_id", "publish_ts", "category"
    )


@query
def vocab_membership(spark, sf):
    words = _train_cells(spark, sf).select("term").distinct()
    return matrix.known_terms(_new_cells(spark, sf), words)


@query
def vocab_unknown(spark, sf):
    words = _train_cells(spark, sf).select("term").distinct()
    return matrix.unknown_terms(_new_cells(spark, sf), words)


# --- scalar functions -------------------------------------------------------------------


@query
def tokenize_terms(spark, sf):
    tokens = keywords.tokenize(views.news(spark, sf))
    return tokens.groupBy("news_id", "term").agg(F.count(F.lit(1)).alias("n"))


@query
def tokenize_bigrams(spark, sf):
    tokens = keywords.tokenize(
        views.news(spark, sf), split=text_functions.terms_with_bigrams
    )
    return tokens.groupBy("news_id", "term").agg(F.count(F.lit(1)).alias("n"))


@query
def parse_publish_time(spark, sf):
    return articles.publish_times(views.news(spark, sf)).select("news_id", "publish_ms")


@query
def composite_key(spark, sf):
    lengths = keywords.doc_lengths(_counts(spark, sf))
    keyed = articles.article_keys(views.news(spark, sf)).join(lengths, "news_id")
    long_key = text_functions.glue_key(
        F.col("news_id"), F.col("n_terms"), epoch_millis(F.col("publish_ts"))
    )
    return keyed.select(
        "article_key",
        long_key.alias("long_key"),
        text_functions.key_part(F.col("article_key"), 1).cast("bigint").alias("id_part"),
        text_functions.key_part(F.col("article_key"), 2).cast("bigint").alias("time_part"),
    )


@query
def keyword_hash(spark, sf):
    words = keywords.doc_frequency(_counts(spark, sf))
    return words.select("term", text_functions.keyword_hash(F.col("term")).alias("term_hash"))


@query
def article_age_hours(spark, sf):
    return _gravity(spark, sf).select("news_id", "age_h")


@query
def recover_counts(spark, sf):
    return keywords.recover_counts(keywords.term_frequency(_counts(spark, sf))).select(
        "news_id", "term", "n", "recovered"
    )


@query
def share_format(spark, sf):
    return _shares(spark, sf).select(
        "user_id", "category", share_text(F.col("share")).alias("share_text")
    )


# --- distinct and dedupe --------------------------------------------------------------------


@query
def dedup_exact(spark, sf):
    return articles.dedup_exact(views.raw_log(spark, sf))


@query
def dedup_exact_content(spark, sf):
    return articles.dedup_exact(views.raw_log(spark, sf), with_time=False)


@query
def dedup_latest(spark, sf):
    return articles.dedup_latest(views.raw_log(spark, sf))


@query
def vocabulary(spark, sf):
    return matrix.vocabulary(_stored_top(spark, sf))


@query
def category_list(spark, sf):
    return profiles.category_list(views.assignment(spark, sf))


@query
def keyword_dictionary(spark, sf):
    return keywords.keyword_dictionary(_stored_tags(spark, sf))


@query
def vocabulary_append(spark, sf):
    """Ids of the training articles' keywords stay when those of all articles are added."""
    train = stored(matrix.vocabulary(_train_cells(spark, sf)), "words")
    return matrix.extended_vocabulary(train, _stored_top(spark, sf)).select("term", "term_id")


# --- joins --------------------------------------------------------------------------------------


@query
def clicks_join_category(spark, sf):
    return profiles.clicks_with_category(
        views.timed_clicks(spark, sf), views.assignment(spark, sf)
    ).select("user_id", "news_id", "publish_ts", "click_ts", "category")


@query
def clicks_without_category(spark, sf):
    return profiles.clicks_without_category(
        views.timed_clicks(spark, sf), views.assignment(spark, sf)
    ).select("user_id", "news_id", "publish_ts", "click_ts")


@query
def label_join_matrix(spark, sf):
    labels = views.assignment(spark, sf).withColumnRenamed("category", "label")
    return matrix.label_rows(labels.select("news_id", "label"), _stored_top(spark, sf))


@query
def clicks_join_keywords(spark, sf):
    return profiles.clicks_with_keywords(views.clicks(spark, sf), _stored_tags(spark, sf)).select(
        "user_id", "news_id", "click_ts", "term", r6("weight")
    )


@query
def doc_vocab_zero_fill(spark, sf):
    top = _stored_top(spark, sf)
    words = stored(matrix.vocabulary(top), "vocabulary")
    filled = matrix.zero_filled(
        views.news(spark, sf).select("news_id"), matrix.doc_term_matrix(top, words), words
    )
    texts = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("indices", "values")]
    return filled.select("news_id", "width", *texts)


@query
def hash_to_keyword(spark, sf):
    tags = _stored_tags(spark, sf)
    hashed = keywords.hash_keywords(tags)
    return keywords.unhash_keywords(hashed, keywords.keyword_dictionary(tags)).select(
        "news_id", "term_hash", "term", r6("weight")
    )


@query
def attach_titles(spark, sf):
    lists = _overlap_lists(spark, sf)
    return ranking.attach_titles(lists, views.news(spark, sf)).select(
        "user_id", "rank", "news_id", "title"
    )


@query
def pref_join_scores(spark, sf):
    """All articles of each category that a user reads, with their place in it."""
    placed = ranking.rank_in_category(_stored_gravity(spark, sf)).withColumnRenamed("rank", "place")
    return ranking.preference_scores(_stored_shares(spark, sf), stored(placed, "placed")).select(
        "user_id", "category", "news_id", "place", r6("score")
    )


# --- aggregations ---------------------------------------------------------------------------------


@query
def term_counts(spark, sf):
    return _counts(spark, sf)


@query
def doc_lengths(spark, sf):
    return keywords.doc_lengths(_counts(spark, sf))


@query
def doc_frequency(spark, sf):
    return keywords.doc_frequency(_counts(spark, sf))


@query
def user_category_counts(spark, sf):
    return _category_counts(spark, sf)


@query
def user_category_share(spark, sf):
    return _shares(spark, sf).select("user_id", "category", r6("share"))


@query
def user_preference_matrix(spark, sf):
    wide = profiles.preference_matrix(_shares(spark, sf))
    return wide.select("user_id", *[r6(c) for c in wide.columns if c != "user_id"])


@query
def user_preference_lines(spark, sf):
    return profiles.preference_lines(profiles.preference_matrix(_shares(spark, sf)))


@query
def cluster_sizes(spark, sf):
    vectors = views.vectors(spark, sf)
    return clusters.cluster_sizes(clusters.assign(vectors, clusters.seeds(vectors)))


@query
def category_distinct_news(spark, sf):
    return ranking.category_sizes(views.assignment(spark, sf))


@query
def user_keyword_profile(spark, sf):
    return _profile(spark, sf).select("user_id", "term", r6("weight"))


@query
def user_profile_map(spark, sf):
    maps = profiles.profile_maps(_profile(spark, sf, parts=PROFILE_PARTS), views.clicks(spark, sf))
    weights = F.map_values("profile")
    total = F.aggregate(weights, F.lit(0.0), lambda total, w: total + w)
    return maps.select(
        "user_id",
        F.col("part").cast("bigint").alias("part"),
        F.array_join(F.map_keys("profile"), "|").alias("terms"),
        r6(total, "total"),
    )


@query
def user_profile_lines(spark, sf):
    return tables.profile_lines(_profile(spark, sf, parts=PROFILE_PARTS), digits=6).select(
        "user_id", F.col("part").cast("bigint").alias("part"), "keywords"
    )


@query
def news_keyword_hashed(spark, sf):
    hashed = keywords.hash_keywords(_stored_tags(spark, sf)).withColumnRenamed("term_hash", "term")
    return tables.keyword_lines(hashed, digits=6)


@query
def classification_accuracy(spark, sf):
    cells, labels = _train_cells(spark, sf), views.labels(spark, sf)
    terms, classes = _model(cells, labels)
    predicted = bayes.predict(labels, cells.select("news_id", "term", "n"), terms, classes)
    return bayes.accuracy(predicted, labels).select("n_docs", "n_correct", r6("accuracy"))


# --- ranking ------------------------------------------------------------------------------------------


@query
def top_keywords(spark, sf):
    return _top(spark, sf).select("news_id", "term", "rank", r6("tfidf"))


@query
def gravity_rank_in_category(spark, sf):
    return ranking.rank_in_category(_gravity(spark, sf)).select(
        "category", "news_id", "rank", r6("gravity")
    )


@query
def top10_per_user(spark, sf):
    lists = _overlap_lists(spark, sf)
    return lists.select("user_id", "news_id", "rank")


@query
def user_score_order(spark, sf):
    """Every user's whole order."""
    return ranking.user_score_order(_stored_shares(spark, sf), _stored_gravity(spark, sf)).select(
        "user_id", "news_id", "category", "rank", r6("score")
    )


@query
def first_n_keywords(spark, sf):
    return keywords.first_keywords(_scored(spark, sf, FIRST_TERMS)).select("news_id", "term", "rank")


@query
def han_keywords(spark, sf):
    """Keywords of texts without spaces between words: letters become Han characters."""
    scored = keywords.article_tfidf(views.han_news(spark, sf), split=text_functions.terms_with_bigrams)
    return keywords.top_keywords(scored).select("news_id", "term", "rank", r6("tfidf"))


# --- text scoring and recommendation ------------------------------------------------------------------------


@query
def term_frequency(spark, sf):
    return keywords.term_frequency(_counts(spark, sf)).select("news_id", "term", r6("tf"))


@query
def inverse_doc_frequency(spark, sf):
    df = keywords.doc_frequency(_counts(spark, sf))
    n_docs = keywords.corpus_size(views.news(spark, sf))
    return keywords.inverse_doc_frequency(df, n_docs).select("term", "df", r6("idf"))


@query
def tfidf(spark, sf):
    return _scored(spark, sf).select("news_id", "term", "n", "n_terms", "df", r6("tfidf"))


@query
def title_body_keywords(spark, sf):
    tags = keywords.title_body_keywords(views.news(spark, sf))
    return tags.select("news_id", "term", r6("weight"))


@query
def doc_term_matrix(spark, sf):
    top = _stored_top(spark, sf)
    return matrix.doc_term_matrix(top, matrix.vocabulary(top))


@query
def doc_term_dense(spark, sf):
    top = _stored_top(spark, sf)
    words = stored(matrix.vocabulary(top), "vocabulary")
    return matrix.sparse_lines(views.news(spark, sf), matrix.doc_term_matrix(top, words), words)


@query
def doc_term_binary(spark, sf):
    top = _stored_top(spark, sf)
    return matrix.binary_matrix(matrix.doc_term_matrix(top, matrix.vocabulary(top)))


@query
def new_doc_matrix(spark, sf):
    words = matrix.vocabulary(_train_cells(spark, sf))
    return matrix.doc_term_matrix(_new_cells(spark, sf), words)


@query
def gravity_score(spark, sf):
    return _gravity(spark, sf).select("category", "news_id", "votes", "age_h", r6("gravity"))


@query
def gravity_by_clicks(spark, sf):
    scored = ranking.gravity_scores(
        views.assignment(spark, sf), views.as_of(), views.clicks(spark, sf)
    )
    return scored.select("category", "news_id", "votes", "age_h", r6("gravity"))


@query
def recommend_by_preference(spark, sf):
    return ranking.recommend_by_preference(_stored_shares(spark, sf), _stored_gravity(spark, sf)).select(
        "user_id", "news_id", "category", "rank", r6("score")
    )


@query
def recommend_new_articles(spark, sf):
    predicted = _classified(spark, sf).withColumnRenamed("label", "category")
    return ranking.recommend_new(stored(predicted, "classified"), _stored_shares(spark, sf), n=None)


@query
def recommend_by_overlap(spark, sf):
    return _overlap_lists(spark, sf).select(
        "user_id", "news_id", "rank", r6("score")
    )


@query
def recommend_unread_by_overlap(spark, sf):
    read = views.clicks(spark, sf).select("user_id", "news_id").distinct()
    return _overlap_lists(spark, sf, read).select("user_id", "news_id", "rank", r6("score"))


def _lists_of(spark, sf, profile, tags):
    lists = ranking.recommend_by_overlap(
        profile, tags, articles=views.news(spark, sf), users=views.clicks(spark, sf)
    )
    return lists.select("user_id", "news_id", "rank", r6("score"))


@query
def recommend_for_session(spark, sf):
    """Slot boost, then overlap, then ten articles."""
    tags = _stored_tags(spark, sf)
    boosted = profiles.slot_boosted_profile(views.clicks(spark, sf), tags, views.as_of())
    return _lists_of(spark, sf, stored(boosted, "boosted"), tags)


@query
def recommend_after_updates(spark, sf):
    """A profile of the earlier clicks, with the later ones from a stream."""
    tags = _stored_tags(spark, sf)
    late = F.col("click_ts") >= F.expr(views.LATE_CLICKS)
    trained = profiles.keyword_profile(views.clicks(spark, sf).where(~late), tags)
    updates = streams.run_updates(views.click_stream(spark, sf).where(late), streams.running_profile(tags))
    return _lists_of(spark, sf, stored(profiles.merged_profile(trained, updates), "merged"), tags)


@query
def overlap_counts(spark, sf):
    return ranking.overlap_counts(*_profile_and_tags(spark, sf)).select(
        "user_id", "news_id", "n_shared", "n_differing", r6("s1"), r6("s2")
    )


# --- machine learning ----------------------------------------------------------------------------------------


@query
def kmeans_seeds(spark, sf):
    picked = clusters.seeds(views.vectors(spark, sf))
    return picked.select("cluster", "vec_id", F.posexplode("embedding").alias("dim", "value")).select(
        "cluster", "vec_id", "dim", r6(F.col("value").cast("double"), "value")
    )


@query
def kmeans_fit(spark, sf):
    vectors = views.vectors(spark, sf)
    assigned = stored(clusters.assign(vectors, clusters.lloyd(vectors)).select("vec_id", "cluster", "distance"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia"))
    return clusters.cluster_sizes(assigned).join(sums, "cluster").select("cluster", "n_members", r6("inertia"))


@query
def kmeans_assign(spark, sf):
    vectors = views.vectors(spark, sf)
    return clusters.assign(vectors, clusters.seeds(vectors)).select(
        "vec_id", "cluster", r6("distance")
    )


@query
def kmeans_centres(spark, sf):
    vectors = views.vectors(spark, sf)
    return clusters.centres(clusters.assign(vectors, clusters.seeds(vectors))).select(
        "cluster", "dim", r6("mean")
    )


@query
def kmeans_articles(spark, sf):
    return clusters.cluster_articles(_stored_top(spark, sf))


@query
def naive_bayes_fit(spark, sf):
    terms = bayes.term_table(_train_cells(spark, sf), views.labels(spark, sf))
    return terms.select("label", "term", "weight", r6("logp"))


@query
def naive_bayes_labels(spark, sf):
    classes = bayes.label_table(_train_cells(spark, sf), views.labels(spark, sf))
    return classes.select("label", "n_docs", "total", r6("prior"), r6("unseen"))


@query
def naive_bayes_info(spark, sf):
    return bayes.model_info(_train_cells(spark, sf), views.labels(spark, sf))


@query
def naive_bayes_predict(spark, sf):
    return _classified(spark, sf).select("news_id", "label", r6("score"))


@query
def label_index(spark, sf):
    return bayes.label_index(views.labels(spark, sf))


# --- described only ---------------------------------------------------------------------------------------------


@query
def decayed_profile(spark, sf):
    return profiles.decayed_profile(
        views.clicks(spark, sf), _stored_tags(spark, sf), views.as_of()
    ).select("user_id", "term", r6("weight"))


@query
def user_hour_distribution(spark, sf):
    return profiles.user_hours(views.clicks(spark, sf)).select(
        "user_id", "slot", "clicks", r6("share")
    )


@query
def slot_boosted_profile(spark, sf):
    return profiles.slot_boosted_profile(
        views.clicks(spark, sf), _stored_tags(spark, sf), views.as_of()
    ).select("user_id", "term", r6("weight"))


# --- streams --------------------------------------------------------------------------------------------------------


@query
def stream_user_profile(spark, sf):
    running = streams.running_profile(_stored_tags(spark, sf))
    return streams.run_updates(views.click_stream(spark, sf), running).select("user_id", "term", r6("weight"))


@query
def stream_decayed_profile(spark, sf):
    kept = streams.run_updates(views.click_stream(spark, sf), streams.running_decay(_stored_tags(spark, sf)))
    return streams.decay_to(kept, views.as_of()).select("user_id", "term", r6("weight"))


@query
def stream_category_counts(spark, sf):
    timed = views.with_publish_time(views.click_stream(spark, sf))
    return streams.run_updates(timed, streams.running_categories(views.assignment(spark, sf)))


@query
def stream_daily_clicks(spark, sf):
    return streams.run_append(streams.daily_click_stream(views.click_stream(spark, sf)))
