"""Gravity of articles and the three recommenders."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.functions.scores import gravity, rank_key
from broadsheet.functions.times import age_hours
from broadsheet.operators.overlap import all_pairs, best_pairs, in_cells
from broadsheet.plans.bitfilter import bit_filter, without_misses
from broadsheet.plans.skew import first_per_group, ranked, salted_join, two_sided_join
from broadsheet.plans.storage import stored
from broadsheet.settings import LIST_BLOCK, LIST_LENGTH, OVERLAP_EPSILON, RANK_DIGITS

# --- gravity ------------------------------------------------------------------


def category_sizes(assignment: DataFrame) -> DataFrame:
    """Distinct articles per category."""
    return assignment.groupBy("category").agg(F.count_distinct("news_id").alias("n_news"))


def gravity_scores(
    assignment: DataFrame, as_of: Column, clicks: DataFrame | None = None
) -> DataFrame:
    """Gravity of each article: votes over the aged power of time.

    The votes are the size of the article's category. With ``clicks`` they are
    the clicks of the article itself, less the first.
    """
    if clicks is None:
        sizes = category_sizes(assignment)
        voted = salted_join(
            assignment, sizes, "category", sizes, "n_news", ["news_id"]
        ).withColumnRenamed("n_news", "votes")
    else:
        per_news = clicks.groupBy("news_id").agg((F.count(F.lit(1)) - 1).alias("votes"))
        voted = assignment.join(per_news, "news_id", "left").withColumn(
            "votes", F.coalesce("votes", F.lit(0))
        )
    aged = voted.withColumn("age_h", age_hours(F.col("publish_ts"), as_of))
    return aged.withColumn("gravity", gravity(F.col("votes"), F.col("age_h")))


def _heavier_first() -> list[tuple[Column, str]]:
    return [(rank_key(F.col("gravity")), "desc"), (F.col("news_id"), "asc")]


def rank_in_category(scored: DataFrame) -> DataFrame:
    """All articles of each category in gravity order."""
    return ranked(scored, _heavier_first(), "rank", ["category"])


# --- by category preference -----------------------------------------------------


def preference_scores(preferences: DataFrame, scored: DataFrame) -> DataFrame:
    """Preference times gravity for the articles of every category a user reads.

    There are few categories and many users, so the join key is always hot:
    pairs are dealt over all tasks. The result has a row for each user and
    article; for a page, give it the articles that can matter, as :func:`category_heads`.
    """
    articles = scored.select("category", "news_id", "gravity", *[c for c in scored.columns if c == "place"])
    joined = two_sided_join(preferences.where("share <> 0"), articles, "category", ["user_id"], ["news_id"])
    return joined.withColumn("score", F.col("share") * F.col("gravity"))


def _best_score_first() -> list[tuple[Column, str]]:
    # gravity decides between equal scores, so that within a category a user's
    # order is always the category's own
    return [(rank_key(F.col("score")), "desc"), *_heavier_first()]


def category_heads(scored: DataFrame, n: int) -> DataFrame:
    """The first ``n`` articles of each category in gravity order, with their ``place`` in it."""
    return first_per_group(scored, ["category"], _heavier_first(), n, "place")


def user_score_order(preferences: DataFrame, scored: DataFrame) -> DataFrame:
    """The whole list of each user, best first; it has all pairs of users and articles they may see."""
    scores = preference_scores(preferences, scored)
    return ranked(scores, _best_score_first(), "rank", ["user_id"])


def user_score_page(preferences: DataFrame, scored: DataFrame, first: int = 1, n: int = LIST_LENGTH) -> DataFrame:
    """Places ``first`` to ``first + n - 1`` of the whole order of each user.

    A category's order is the same for all its readers, so a user's order is a
    merge of the ranked lists of the categories read, and a place in it is never
    before the place in the category's own list: the heads of the lists up to
    the page's end are all that is merged. This is exact.
    """
    last = first + n - 1
    scores = preference_scores(preferences, category_heads(scored, last)).drop("place")
    return first_per_group(scores, ["user_id"], _best_score_first(), last).where(F.col("rank") >= first)


def recommend_by_preference(
    preferences: DataFrame, scored: DataFrame, n: int = LIST_LENGTH
) -> DataFrame:
    """The ``n`` best articles of each user: the first page of the order."""
    return user_score_page(preferences, scored, 1, n)


def in_preferred_categories(articles: DataFrame, preferences: DataFrame) -> DataFrame:
    """Articles whose category somebody reads."""
    wanted = stored(preferences.where("share <> 0").select("category").distinct(), "wanted")
    maybe = without_misses(articles, ["category"], bit_filter(wanted, ["category"]))
    return salted_join(maybe, wanted, "category", category_sizes(maybe), "n_news", ["news_id"])


def recommend_new(
    classified: DataFrame, preferences: DataFrame, first: int = 1, n: int | None = LIST_LENGTH
) -> DataFrame:
    """Newly classified articles in the categories a user reads, from place ``first`` on, ``n`` of them.

    The best liked category comes first; within a category articles go by id.
    Without ``n``, the whole list of each user.
    """
    articles = classified.select("news_id", "category")
    liked = preferences.where("share <> 0").select("user_id", "category", "share")
    order = [(rank_key(F.col("share")), "desc"), (F.col("category"), "asc"), (F.col("news_id"), "asc")]
    if n is None:
        page = _whole_lists(liked, articles)
    else:
        last = first + n - 1
        heads = first_per_group(articles, ["category"], [(F.col("news_id"), "asc")], last, "place")
        met = two_sided_join(liked, heads.drop("place"), "category", ["user_id"], ["news_id"])
        page = first_per_group(met, ["user_id"], order, last)
    return page.where(F.col("rank") >= first).select("user_id", "news_id", "category", "rank")


def _whole_lists(liked: DataFrame, articles: DataFrame) -> DataFrame:
    """The whole list of each user, category after category.

    An article's rank is its place in its category's own order behind all articles
    of the categories liked better, so pairs are neither sorted nor kept.
    """
    placed = stored(ranked(articles, [(F.col("news_id"), "asc")], "place", ["category"]), "placed")
    sizes = stored(placed.groupBy("category").agg(F.count(F.lit(1)).alias("size")), "sizes")
    # the same liking twice makes every article come twice, one after the other
    kept = liked.groupBy("user_id", "category", rank_key(F.col("share")).alias("liking")).agg(F.count(F.lit(1)).alias("copies"))
    readers = kept.groupBy("category").agg(F.count(F.lit(1)).alias("readers"))
    sized = salted_join(kept, sizes, "category", readers, "readers", ["user_id"])
    better = Window.partitionBy("user_id").orderBy(F.desc("liking"), F.asc("category")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("size") * F.col("copies")).over(better), F.lit(0))
    begun = sized.select("user_id", "category", "copies", before.alias("before"))
    begun = stored(begun.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))), "begun")
    met = two_sided_join(begun, placed, "category", ["user_id"], ["news_id"])
    return met.withColumn("rank", F.col("before") + (F.col("place") - 1) * F.col("copies") + F.col("copy"))


# --- by weighted keyword overlap --------------------------------------------------


def _with_news_totals(keywords: DataFrame) -> DataFrame:
    """Keywords with their article's total; an article has few of them."""
    article = Window.partitionBy("news_id")
    return keywords.select(
        "news_id",
        "term",
        "weight",
        F.sum("weight").over(article).alias("news_weight"),
        F.count(F.lit(1)).over(article).alias("news_tags"),
    )


def overlap_counts(profile: DataFrame, keywords: DataFrame) -> DataFrame:
    """Shared and differing keywords of each (user, article) that share one.

    ``s1`` and ``s2`` are the weights of the shared and of the differing ones.
    """
    known = profile.where("user_id IS NOT NULL")
    tags = _with_news_totals(keywords).withColumnRenamed("weight", "tag_weight")
    pair = _pair_schema(profile, tags)
    return in_cells(known, tags, all_pairs(OVERLAP_EPSILON), f"{pair}, n_shared long, n_differing long, s1 double, s2 double")


def _pair_schema(profile: DataFrame, tags: DataFrame) -> str:
    types = [f.schema[c].dataType.simpleString() for f, c in ((profile, "user_id"), (tags, "news_id"))]
    return f"user_id {types[0]}, news_id {types[1]}"


def overlap_score(shared: Column, user_weight: Column, news_weight: Column) -> Column:
    """Shared weight over all weight, a weighted Dice coefficient."""
    epsilon = F.lit(OVERLAP_EPSILON)
    return (epsilon + shared) / (epsilon + user_weight + news_weight)


# The lists of readers are found without scoring all pairs and without shuffling
# any: see `overlap.best_pairs`.


def overlap_candidates(profile: DataFrame, tags: DataFrame, n: int, read: DataFrame | None = None) -> DataFrame:
    """Scores of the pairs (user, article) that may be among a user's first ``n``.

    ``tags`` carry their article's totals (``tag_weight``, ``news_weight``).
    Weights must not be negative.
    """
    task = best_pairs(OVERLAP_EPSILON, n, RANK_DIGITS, LIST_BLOCK)
    uncounted = tags.withColumn("news_tags", F.lit(0))
    return in_cells(profile, uncounted, task, f"{_pair_schema(profile, tags)}, score double", read)


def _best_overlap_first() -> list[tuple[Column, str]]:
    return [(rank_key(F.col("score")), "desc"), (F.col("news_id"), "desc")]


def recommend_by_overlap(
    profile: DataFrame,
    keywords: DataFrame,
    n: int = LIST_LENGTH,
    read: DataFrame | None = None,
    articles: DataFrame | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """The ``n`` articles of each user with the largest overlap score.

    Articles a user has read stay in unless ``read`` (user, article) is given.
    A user who shares keywords with fewer than ``n`` articles also gets the
    best of the others, those of smallest total weight, so that all lists have
    ``n`` articles if there are as many. ``articles`` (``news_id``) are all
    candidates, also those without keywords, whose weight is zero; ``users``
    are all readers, also those with an empty profile. Without them, those in
    ``keywords`` and ``profile``. Scores are compared on nine digits; weights
    must not be negative. Lists are exact, though most pairs are never made.
    """
    tags = _with_news_totals(keywords).withColumnRenamed("weight", "tag_weight")
    scored = overlap_candidates(profile, tags, n, read)
    best = first_per_group(scored, ["user_id"], _best_overlap_first(), n).select("user_id", "news_id", "score", "rank")
    best = stored(best, "lists")
    weights = _total(keywords, "news_id", "news_weight", articles)
    readers = _total(profile, "user_id", "user_weight", users)
    return best.unionByName(_padding(best, readers, weights, n, read))


def _total(weighted: DataFrame, key: str, name: str, everyone: DataFrame | None) -> DataFrame:
    """Total weight per key; zero for those in ``everyone`` that have none."""
    totals = weighted.groupBy(key).agg(F.sum("weight").alias(name))
    if everyone is None:
        return totals
    return everyone.select(key).distinct().join(totals, key, "left").fillna(0.0, [name])


def _padding(
    best: DataFrame, users: DataFrame, articles: DataFrame, n: int, read: DataFrame | None
) -> DataFrame:
    """The tail of lists that overlap alone leaves short.

    Without shared keywords the score only depends on the article's total
    weight, so one order of the articles, lightest first, serves all users. A
    user looks at as many of its first places as are missing, and one more for
    each article that is on the list or read already: no user meets all
    articles.
    """
    order = [(rank_key(F.col("news_weight")), "asc"), (F.col("news_id"), "desc")]
    places = stored(ranked(articles, order, "place"), "places")
    lengths = best.groupBy("user_id").agg(F.max("rank").alias("filled"))
    short = stored(
        users.join(lengths, "user_id", "left").fillna(0, ["filled"]).where(F.col("filled") < n), "short"
    )
    out = best.select("user_id", "news_id")
    if read is not None:
        out = out.unionByName(read.select("user_id", "news_id")).distinct()
    out = stored(out.join(short, "user_id", "left_semi"), "out")
    seen = out.groupBy("news_id").agg(F.count(F.lit(1)).alias("seen"))
    taken = salted_join(out, places.select("news_id", "place"), "news_id", seen, "seen", ["user_id"])
    taken = stored(taken.select("user_id", "place"), "taken")
    left_out = taken.groupBy("user_id").agg(F.count(F.lit(1)).alias("left_out"))
    missing = n - F.col("filled")
    looked_at = (
        short.join(left_out, "user_id", "left")
        .withColumn("place", F.explode(F.sequence(F.lit(1).cast("bigint"), missing + F.coalesce("left_out", F.lit(0)))))
        .join(taken, ["user_id", "place"], "left_anti")
    )
    free = first_per_group(looked_at, ["user_id"], [(F.col("place"), "asc")], n, "next")
    free = stored(free.where(F.col("next") <= missing).drop("left_out"), "free")
    wanted = free.groupBy("place").agg(F.count(F.lit(1)).alias("wanted"))
    return salted_join(free, places, "place", wanted, "wanted", ["user_id"]).select(
        "user_id",
        "news_id",
        overlap_score(F.lit(0.0), F.col("user_weight"), F.col("news_weight")).alias("score"),
        (F.col("filled") + F.col("next")).cast("int").alias("rank"),
    )


def attach_titles(lists: DataFrame, articles: DataFrame) -> DataFrame:
    """Titles of recommended articles; popular ones are on many lists."""
    shown = lists.groupBy("news_id").agg(F.count(F.lit(1)).alias("shown"))
    return salted_join(
        lists, articles.select("news_id", "title"), "news_id", shown, "shown", ["user_id"]
    )
