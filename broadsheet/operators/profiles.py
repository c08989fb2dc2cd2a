"""What users read: by category, by keyword, by time of day.

Clicks are first counted per (user, article). A click repeated a million times
is then one row with a weight, before any join.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.functions.scores import decay, share_text
from broadsheet.functions.text import keyword_hash
from broadsheet.functions.times import hour_slot, hours_between
from broadsheet.plans.bitfilter import bit_filter, maybe_in
from broadsheet.plans.skew import salted_join
from broadsheet.plans.storage import stored
from broadsheet.settings import (
    HALF_LIFE_HOURS,
    PROFILE_PARTS,
    SLOT_BOOST,
    SLOT_HOURS,
)

ARTICLE = ["news_id", "publish_ts"]


def _rows_per(frame: DataFrame, keys: list[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


# --- by category --------------------------------------------------------------


def clicks_with_category(
    clicks: DataFrame, assignment: DataFrame, on: list[str] = ARTICLE
) -> DataFrame:
    """Clicks of articles that have a category."""
    rows = _rows_per(clicks, on)
    return salted_join(clicks, assignment, on, rows, "rows", clicks.columns)


def clicks_without_category(clicks: DataFrame, assignment: DataFrame) -> DataFrame:
    """Clicks of articles that have none."""
    marked = assignment.select(*ARTICLE, F.lit(True).alias("known"))
    joined = salted_join(
        clicks, marked, ARTICLE, _rows_per(clicks, ARTICLE), "rows", clicks.columns, "left"
    )
    return joined.where("known IS NULL").drop("known")


def user_category_counts(
    clicks: DataFrame, assignment: DataFrame, on: list[str] = ARTICLE
) -> DataFrame:
    """Clicks per (user, category), repeated clicks included."""
    counted = clicks.groupBy("user_id", *on).agg(F.count(F.lit(1)).alias("clicks"))
    return (
        clicks_with_category(counted, assignment, on)
        .groupBy("user_id", "category")
        .agg(F.sum("clicks").alias("clicks"))
    )


def user_category_share(counts: DataFrame) -> DataFrame:
    """Part of a user's clicks that fell in each category.

    A user has at most one row per category here, so the window is small.
    """
    total = F.sum("clicks").over(Window.partitionBy("user_id"))
    return counts.withColumn("share", F.col("clicks") / total)


def category_list(assignment: DataFrame) -> DataFrame:
    """All categories, in text order."""
    return assignment.select(F.col("category").cast("string").alias("category")).distinct().orderBy(
        "category"
    )


def preference_matrix(shares: DataFrame, categories: list[int] | None = None) -> DataFrame:
    """One row per user, one column per category, zero where nothing was read.

    Without a list, the columns are all categories read, in text order. Their
    number is the width of the table, so it is small.
    """
    if categories is None:
        categories = [r.category for r in shares.select("category").distinct().collect() if r.category is not None]
        categories.sort(key=str)
    wide = shares.groupBy("user_id").pivot("category", categories).agg(F.first("share"))
    return wide.select(
        "user_id",
        *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(f"cat_{c}") for c in categories],
    )


def preference_lines(matrix: DataFrame) -> DataFrame:
    """The shares of a user as one text, in column order."""
    columns = [c for c in matrix.columns if c != "user_id"]
    return matrix.select(
        "user_id", F.concat_ws(" ", *[share_text(F.col(c)) for c in columns]).alias("shares")
    )


def nonzero_preferences(matrix: DataFrame) -> DataFrame:
    """Back to one row per (user, category), without the zeros."""
    columns = [c for c in matrix.columns if c != "user_id"]
    pairs = F.array(
        *[
            F.struct(F.lit(int(c.split("_")[1])).alias("category"), F.col(c).alias("share"))
            for c in columns
        ]
    )
    return (
        matrix.select("user_id", F.explode(pairs).alias("p"))
        .select("user_id", "p.category", "p.share")
        .where("share <> 0")
    )


# --- by keyword ---------------------------------------------------------------


def clicks_with_keywords(clicks: DataFrame, keywords: DataFrame) -> DataFrame:
    """The keywords behind every click; articles without any add nothing."""
    rows = _rows_per(clicks, ["news_id"])
    return salted_join(clicks, keywords, "news_id", rows, "rows", clicks.columns)


def _weigh(clicks: DataFrame, keywords: DataFrame, amount: Column, parts: int | None = None) -> DataFrame:
    counted = clicks.groupBy("user_id", "news_id").agg(amount.alias("amount"))
    weighed = clicks_with_keywords(counted, keywords).select(
        "user_id", "term", (F.col("amount") * F.col("weight")).alias("weight")
    )
    keys = ["user_id", "term"]
    if parts is not None:
        weighed = profile_parts(weighed, parts).repartition("user_id", "part")
        keys = ["user_id", "part", "term"]
    return weighed.groupBy(*keys).agg(F.sum("weight").alias("weight"))


def keyword_profile(clicks: DataFrame, keywords: DataFrame, parts: int | None = None) -> DataFrame:
    """Weight of each keyword for a user: the sum over all clicks.

    With ``parts`` the rows also have their ``part`` (see :func:`profile_parts`) and
    are dealt by it, so what is collected from them needs no further shuffle.
    """
    return _weigh(clicks, keywords, F.count(F.lit(1)), parts)


def decayed_profile(
    clicks: DataFrame,
    keywords: DataFrame,
    as_of: Column,
    half_life_hours: float = HALF_LIFE_HOURS,
) -> DataFrame:
    """Like :func:`keyword_profile`, but a click halves in weight per half-life."""
    faded = decay(hours_between(F.col("click_ts"), as_of), half_life_hours)
    return _weigh(clicks, keywords, F.sum(faded))


def merged_profile(trained: DataFrame, updates: DataFrame) -> DataFrame:
    """A trained profile and the sums of the clicks since then as one profile."""
    columns = ["user_id", "term", "weight"]
    both = trained.select(*columns).unionByName(updates.select(*columns))
    return both.groupBy("user_id", "term").agg(F.sum("weight").alias("weight"))


def user_hours(clicks: DataFrame, slot_hours: int = SLOT_HOURS) -> DataFrame:
    """When users read: share of clicks per slot of the day."""
    counted = clicks.groupBy(
        "user_id", hour_slot(F.col("click_ts"), slot_hours).alias("slot")
    ).agg(F.count(F.lit(1)).alias("clicks"))
    return user_category_share(counted)


def slot_boosted_profile(
    clicks: DataFrame,
    keywords: DataFrame,
    as_of: Column,
    slot_hours: int = SLOT_HOURS,
    boost: float = SLOT_BOOST,
) -> DataFrame:
    """The profile with more weight on keywords read in the current slot.

    One pass: whether a keyword was read in the slot is carried along as a
    maximum, so profile and boost come from the same join.
    """
    in_slot = hour_slot(F.col("click_ts"), slot_hours) == hour_slot(as_of, slot_hours)
    counted = clicks.groupBy("user_id", "news_id").agg(
        F.count(F.lit(1)).alias("amount"), F.max(in_slot).alias("in_slot")
    )
    return (
        clicks_with_keywords(counted, keywords)
        .groupBy("user_id", "term")
        .agg(
            F.sum(F.col("amount") * F.col("weight")).alias("weight"),
            F.max("in_slot").alias("in_slot"),
        )
        .withColumn(
            "weight", F.when(F.col("in_slot"), F.col("weight") * boost).otherwise(F.col("weight"))
        )
    )


def profile_parts(profile: DataFrame, parts: int = PROFILE_PARTS) -> DataFrame:
    """Deals the keywords of every user over ``parts`` rows, by a hash of the term.

    The number is the same for all users, so the shape of a collected profile
    does not depend on how much there is of it; raise it for longer profiles. A
    profile that has its parts already is left as it is.
    """
    if "part" in profile.columns:
        return profile
    bucket = F.conv(F.substring(keyword_hash(F.col("term")), 1, 8), 16, 10).cast("bigint")
    return profile.withColumn("part", F.pmod(bucket, F.lit(parts)))


def profile_maps(
    profile: DataFrame, users: DataFrame | None = None, parts: int = PROFILE_PARTS
) -> DataFrame:
    """Profiles as maps, a row per user and part that has keywords.

    With ``users`` those without any keyword get an empty map.
    """
    entries = F.array_sort(F.collect_list(F.struct("term", "weight")))
    maps = (
        profile_parts(profile, parts)
        .groupBy("user_id", "part")
        .agg(F.map_from_entries(entries).alias("profile"))
    )
    if users is None:
        return maps
    maps, everyone = stored(maps.where("user_id IS NOT NULL"), "maps"), stored(users.select("user_id").distinct(), "users")
    known = maps.select("user_id").distinct()
    idle = everyone.join(known, "user_id", "left_anti")
    empty = F.expr("cast(map() as map<string,double>)")
    kept = _of_users(maps, stored(known.join(everyone, "user_id", "left_anti"), "strangers"))
    return kept.unionByName(idle.select("user_id", F.lit(0).cast(maps.schema["part"].dataType).alias("part"), empty.alias("profile")))


def _of_users(maps: DataFrame, strangers: DataFrame) -> DataFrame:
    """The maps of all but the strangers; only those that may be a stranger's are shuffled."""
    marked = maybe_in(maps, ["user_id"], bit_filter(strangers, ["user_id"]), "_maybe")
    sure = marked.where(~F.col("_maybe")).drop("_maybe")
    return sure.unionByName(marked.where("_maybe").drop("_maybe").join(strangers, "user_id", "left_anti").select(*maps.columns))


def profile_map(profile: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """The whole profile of a user as one map; with ``users`` those without keywords get an empty one.

    A map is one row of one user, so it is as large as the profile; use
    :func:`profile_maps` where a profile may outgrow a row.
    """
    whole = profile_maps(profile).groupBy("user_id").agg(
        F.flatten(F.collect_list(F.map_entries("profile"))).alias("entries")
    )
    whole = whole.select("user_id", F.map_from_entries(F.array_sort("entries")).alias("profile"))
    if users is None:
        return whole
    empty = F.expr("cast(map() as map<string,double>)")
    everyone = users.select("user_id").distinct()
    return everyone.join(whole, "user_id", "left").select("user_id", F.coalesce("profile", empty).alias("profile"))
