"""The operators put together: from a click log to recommendations.

Stage tables are stored between the steps, so that every step is planned on
tables of known size.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.functions.text import SPLITS
from broadsheet.functions.times import parse_publish_time
from broadsheet.operators import articles, bayes, clusters, keywords, profiles, ranking
from broadsheet.plans.session import prepare
from broadsheet.plans.storage import stored
from broadsheet.settings import CLUSTERS, LIST_LENGTH
from broadsheet.sources.tables import load_state, save_state

PROFILE_TABLES = ["articles", "tags", "dictionary", "profiles", "split"]
CATEGORY_TABLES = ["assignment", "terms", "classes", "split"]


def article_list(log: DataFrame) -> DataFrame:
    """The articles of a log, each in its latest version, with a publish time."""
    latest = articles.dedup_latest(log)
    return latest.withColumn("publish_ts", parse_publish_time(F.col("publish_text")))


def _split_table(spark: SparkSession, split: str) -> DataFrame:
    return spark.range(1).select(F.lit(split).alias("split"))


def _kept_split(spark: SparkSession, folder: str):
    """How the model cut its texts, so that new ones are cut alike."""
    return SPLITS[load_state(spark, folder, ["split"])["split"].first()["split"]]


# --- by keyword profile ---------------------------------------------------------


def train_profiles(log: DataFrame, folder: str, split: str = "terms") -> dict[str, DataFrame]:
    """Article keywords, keyword dictionary and user profiles, kept in ``folder``.

    ``split`` is "terms", or "bigrams" for Chinese texts; it is kept as well.
    """
    spark = prepare(log.sparkSession)
    news = stored(article_list(log), "articles")
    tags = stored(keywords.title_body_keywords(news, SPLITS[split]), "tags")
    clicks = articles.brief_clicks(log)
    save_state(
        {
            "split": _split_table(spark, split),
            "articles": news,
            "tags": tags,
            "dictionary": keywords.keyword_dictionary(tags),
            "profiles": profiles.keyword_profile(clicks, tags),
        },
        folder,
    )
    return load_state(spark, folder, PROFILE_TABLES)


def recommend_from_profiles(
    spark: SparkSession,
    folder: str,
    candidates: DataFrame,
    users: DataFrame | None = None,
    n: int = LIST_LENGTH,
) -> DataFrame:
    """Lists of candidate articles (a log like the trained one) for users.

    Candidates are weighed on their own corpus. ``users`` (``user_id``) picks
    the readers; without it all that have a profile get a list.
    """
    prepare(spark)
    return _lists(spark, folder, load_state(spark, folder, ["profiles"])["profiles"], candidates, users, n)


def recommend_after_updates(
    spark: SparkSession,
    folder: str,
    updates: DataFrame,
    candidates: DataFrame,
    users: DataFrame | None = None,
    n: int = LIST_LENGTH,
) -> DataFrame:
    """The same lists with the clicks since the training.

    ``updates`` (user, term, weight) are the running sums of a stream over the
    kept ``tags``, as ``streaming.clicks.latest`` reads them.
    """
    prepare(spark)
    trained = load_state(spark, folder, ["profiles"])["profiles"]
    profile = stored(profiles.merged_profile(trained, updates), "merged")
    return _lists(spark, folder, profile, candidates, users, n)


def recommend_for_session(
    spark: SparkSession,
    folder: str,
    log: DataFrame,
    candidates: DataFrame,
    as_of: Column,
    users: DataFrame | None = None,
    n: int = LIST_LENGTH,
) -> DataFrame:
    """Lists for one moment: what users read in its time slot weighs more."""
    prepare(spark)
    tags = load_state(spark, folder, ["tags"])["tags"]
    boosted = profiles.slot_boosted_profile(articles.brief_clicks(log), tags, as_of)
    return _lists(spark, folder, stored(boosted, "boosted"), candidates, users, n)


def _lists(
    spark: SparkSession, folder: str, profile: DataFrame, candidates: DataFrame, users: DataFrame | None, n: int
) -> DataFrame:
    if users is not None:
        profile = profile.join(users.select("user_id").distinct(), "user_id", "left_semi")
    news = stored(article_list(candidates), "candidates")
    tags = stored(keywords.title_body_keywords(news, _kept_split(spark, folder)), "tags")
    lists = ranking.recommend_by_overlap(profile, tags, n, articles=news, users=users)
    return ranking.attach_titles(lists, news)


# --- by category ------------------------------------------------------------------


def _cells(news: DataFrame, split) -> DataFrame:
    top = keywords.top_keywords(keywords.article_tfidf(news, split=split))
    return stored(top.select("news_id", "term", "n"), "top-keywords")


def train_categories(
    log: DataFrame, folder: str, k: int = CLUSTERS, split: str = "terms"
) -> dict[str, DataFrame]:
    """Categories of the articles and a classifier for new ones, in ``folder``."""
    spark = prepare(log.sparkSession)
    news = stored(article_list(log), "articles")
    cells = _cells(news, SPLITS[split])
    grouped = clusters.cluster_articles(cells, k).withColumnRenamed("cluster", "category")
    assignment = stored(grouped.join(news.select("news_id", "publish_ts"), "news_id"), "assignment")
    labels = assignment.select("news_id", F.col("category").alias("label"))
    labelled = stored(bayes.labelled_cells(cells, labels), "labelled")
    save_state(
        {
            "split": _split_table(spark, split),
            "assignment": assignment,
            "terms": bayes.term_table(labelled, labels),
            "classes": bayes.label_table(labelled, labels),
        },
        folder,
    )
    return load_state(spark, folder, CATEGORY_TABLES)


def classify_new(spark: SparkSession, folder: str, candidates: DataFrame) -> DataFrame:
    """The category of each new article."""
    prepare(spark)
    model = load_state(spark, folder, CATEGORY_TABLES)
    news = stored(article_list(candidates), "candidates")
    predicted = bayes.predict(news, _cells(news, _kept_split(spark, folder)), model["terms"], model["classes"])
    return predicted.select("news_id", F.col("label").alias("category")).join(
        news.select("news_id", "publish_ts"), "news_id"
    )


def preferences(log: DataFrame, assignment: DataFrame) -> DataFrame:
    """Share of each category in what a user reads.

    Clicks and categories meet on the article alone: a line may carry the
    publish time of an older version, and its click counts like the others.
    """
    categories = assignment.select("news_id", "category")
    counts = profiles.user_category_counts(articles.user_news_map(log), categories, ["news_id"])
    return profiles.user_category_share(counts).select("user_id", "category", "share")


def recommend_from_categories(
    log: DataFrame, assignment: DataFrame, as_of: Column, n: int = LIST_LENGTH
) -> DataFrame:
    """The ``n`` best known articles of every user, by preference and gravity."""
    prepare(log.sparkSession)
    shares = stored(preferences(log, assignment), "shares")
    scored = stored(ranking.gravity_scores(assignment, as_of), "gravity")
    return ranking.recommend_by_preference(shares, scored, n)


def recommend_new(
    spark: SparkSession, folder: str, log: DataFrame, candidates: DataFrame, as_of: Column, n: int = LIST_LENGTH
) -> DataFrame:
    """The ``n`` best new articles of every user: classified first, then by preference and gravity."""
    prepare(spark)
    assignment = load_state(spark, folder, ["assignment"])["assignment"]
    shares = stored(preferences(log, assignment), "shares")
    new = stored(classify_new(spark, folder, candidates), "classified")
    scored = stored(ranking.gravity_scores(new, as_of), "gravity")
    return ranking.recommend_by_preference(shares, scored, n)
