"""Operators on tiny frames, against plain Python and hand-worked values."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from broadsheet.operators import articles, bayes, clusters, keywords, matrix, profiles, ranking

DOCS = [
    (1, "Red fox", "red fox red den fox red"),
    (2, "Blue sea", "blue sea and red sky"),
    (3, "", ""),
    (4, "Green", "green green green hill and sea"),
]


@pytest.fixture
def news(frame):
    return frame(DOCS, "news_id long, title string, content string")


def brute_tfidf(docs):
    counts = {d: Counter(text.lower().split()) for d, text in docs}
    df = Counter(t for c in counts.values() for t in c)
    return {
        (d, t): n / sum(c.values()) * math.log10(len(docs) / df[t])
        for d, c in counts.items()
        for t, n in c.items()
    }


# --- articles -------------------------------------------------------------------


LOG = "user_id long, news_id long, click_ts timestamp_ntz, title string, content string, publish_text string"


def test_repeated_clicks_are_one_article_of_unknown_time(frame, at, rows):
    log = frame([(7, 5, at(h), "t", "c", "NULL") for h in (1, 2)], LOG)
    (only,) = articles.dedup_exact(log).collect()
    assert (only["news_id"], only["publish_ts"].year) == (5, 1970)
    assert articles.user_news_map(log).count() == 2


def test_two_versions_of_an_article(frame, at, rows):
    log = frame([(7, 5, at(1), "t", "old", "NULL"), (8, 5, at(3), "t", "new", "NULL"), (7, 5, at(2), "t", "old", "NULL")], LOG)
    assert rows(articles.dedup_exact(log), "content") == [("new",), ("old",)]
    assert rows(articles.dedup_latest(log), "news_id", "content") == [(5, "new")]


# --- keywords -------------------------------------------------------------------


def test_tfidf_equals_the_formula(news, rows):
    want = brute_tfidf([(d, c) for d, _, c in DOCS])
    got = {(r["news_id"], r["term"]): r["tfidf"] for r in keywords.article_tfidf(news).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in want)


def test_term_frequencies_of_a_doc_sum_to_one(news):
    tf = keywords.term_frequency(keywords.term_counts(news))
    for r in tf.groupBy("news_id").agg(F.sum("tf").alias("s")).collect():
        assert math.isclose(r["s"], 1.0)


def test_fixed_corpus_size_may_give_negative_weights(news):
    counts = keywords.term_counts(news)
    scored = keywords.tfidf(counts, F.lit(1))
    assert scored.where("term = 'sea'").first()["tfidf"] < 0


def test_top_keywords_break_ties_in_term_order(news, rows):
    top = keywords.top_keywords(keywords.article_tfidf(news), 2)
    assert rows(top.where("news_id = 2"), "rank", "term") == [(1, "blue"), (2, "sky")]


def test_title_weight_is_added_to_body_weight(news):
    body = brute_tfidf([(d, c) for d, _, c in DOCS])
    got = {(r["news_id"], r["term"]): r["weight"] for r in keywords.title_body_keywords(news).collect()}
    fox = body[1, "fox"] + 0.5 * math.log10(4 / 1)
    assert math.isclose(got[1, "fox"], fox)
    assert math.isclose(got[1, "den"], body[1, "den"])


def test_a_term_in_every_article_is_no_keyword(frame):
    same = frame([(1, "x", "x a"), (2, "x", "x b")], "news_id long, title string, content string")
    terms = {r["term"] for r in keywords.title_body_keywords(same).collect()}
    assert terms == {"a", "b"}


def test_hashing_keywords_and_back(news, rows):
    tags = keywords.title_body_keywords(news)
    back = keywords.unhash_keywords(keywords.hash_keywords(tags), keywords.keyword_dictionary(tags))
    assert rows(back, "news_id", "term", "weight") == rows(tags, "news_id", "term", "weight")


# --- matrix ---------------------------------------------------------------------


@pytest.fixture
def cells(frame):
    return frame(
        [(1, "a", 2), (1, "c", 1), (2, "b", 1), (2, "c", 3), (4, "zz", 1)],
        "news_id long, term string, n long",
    )


def test_vocabulary_is_numbered_in_term_order(cells, rows):
    assert rows(matrix.vocabulary(cells), "term_id", "term") == [(0, "a"), (1, "b"), (2, "c"), (3, "zz")]


def test_rows_over_the_whole_vocabulary(frame, cells):
    docs = frame([(i,) for i in (1, 2, 3)], "news_id long")
    words = matrix.vocabulary(cells)
    filled = matrix.zero_filled(docs, matrix.doc_term_matrix(cells, words), words)
    assert {r["news_id"]: (r["width"], r["indices"], r["values"]) for r in filled.collect()} == {
        1: (4, [0, 2], [2, 1]), 2: (4, [1, 2], [1, 3]), 3: (4, [], []),
    }


def test_no_keyword_is_cut_from_a_wide_vocabulary(frame, at):
    cells = frame([(d, f"t{d}-{i}", i + 1) for d in range(60) for i in range(50)], "news_id long, term string, n long")
    docs = frame([(d, at(d)) for d in range(60)], "news_id long, publish_ts timestamp_ntz")
    words = matrix.vocabulary(cells)
    lines = matrix.sparse_lines(docs, matrix.doc_term_matrix(cells, words), words).collect()
    assert all(r["line"].split(" ")[1] == "3000" for r in lines)
    assert sum(int(pair.split(":")[1]) for r in lines for pair in r["line"].split(" ")[2:]) == 60 * 51 * 25


def test_known_and_unknown_terms_part_the_cells(cells, frame, rows):
    words = frame([("a",), ("c",)], "term string")
    known = rows(matrix.known_terms(cells, words), "news_id", "term")
    unknown = rows(matrix.unknown_terms(cells, words), "news_id", "term")
    assert known == [(1, "a"), (1, "c"), (2, "c")] and unknown == [(2, "b"), (4, "zz")]


def test_label_rows_keep_both_sides(frame, cells, rows):
    labels = frame([(1, 7), (9, 8)], "news_id long, label int")
    assert rows(matrix.label_rows(labels, cells), "news_id", "line") == [
        (1, "7,a:2,c:1"), (2, ",b:1,c:3"), (4, ",zz:1"), (9, "8,"),
    ]


# --- profiles -------------------------------------------------------------------


def test_nine_clicks_in_two_categories(frame, at, rows):
    """One article is clicked twice and counts twice: 8/9 and 1/9."""
    read = [11, 12, 13, 14, 15, 16, 17, 11, 18]
    log = frame([(9106148, n, at(0)) for n in read], "user_id long, news_id long, publish_ts timestamp_ntz")
    known = frame([(n, at(0), 37 if n == 18 else 10) for n in range(11, 19)], "news_id long, publish_ts timestamp_ntz, category int")
    order = [0, 10, 17, 29, 33, 37, 38, 53, 69, 72]
    shares = profiles.user_category_share(profiles.user_category_counts(log, known))
    wide = profiles.preference_matrix(shares, order)
    assert rows(profiles.preference_lines(wide), "user_id", "shares") == [
        (9106148, "0.00 0.889 0.00 0.00 0.00 0.111 0.00 0.00 0.00 0.00")
    ]
    assert rows(profiles.nonzero_preferences(wide), "category") == [(10,), (37,)]


def test_categories_sort_as_text(frame):
    known = frame([(c,) for c in (9, 10, 2, 33)], "category int")
    assert [r[0] for r in profiles.category_list(known).collect()] == ["10", "2", "33", "9"]


CLICKS = "user_id long, news_id long, click_ts timestamp_ntz"
TAGS = "news_id long, term string, weight double"


def test_profile_sums_over_clicks_and_keeps_users_without_keywords(frame, at):
    clicks = frame([(1, 5, at(0)), (1, 5, at(9)), (1, 6, at(1)), (2, 99, at(0))], CLICKS)
    tags = frame([(5, "a", 0.5), (5, "b", 0.25), (6, "a", 1.0)], TAGS)
    maps = profiles.profile_map(profiles.keyword_profile(clicks, tags), clicks)
    assert {r["user_id"]: r["profile"] for r in maps.collect()} == {1: {"a": 2.0, "b": 0.5}, 2: {}}


def test_profiles_are_dealt_over_the_same_parts_for_all_users(frame):
    profile = frame([(1, f"t{i}", 1.0) for i in range(100)] + [(2, "t7", 1.0)], "user_id long, term string, weight double")
    parts = defaultdict(dict)
    for r in profiles.profile_maps(profile, parts=10).collect():
        parts[r["user_id"]][r["part"]] = r["profile"]
    assert len(parts[1]) > 5 and sum(map(len, parts[1].values())) == 100
    ((part, only),) = parts[2].items()
    assert only == {"t7": 1.0} and "t7" in parts[1][part]


def test_profiles_dealt_by_part_are_shuffled_once(frame, at):
    """What is collected by part uses the shuffle that summed the weights."""
    clicks = frame([(u, a, at(a)) for u in range(9) for a in range(u)] + [(None, 3, at(0)), (50, 99, at(0))], CLICKS)
    tags = frame([(a, f"t{(a * k) % 11}", 1.0 + k) for a in range(9) for k in range(4)], TAGS)
    plain, dealt = profiles.keyword_profile(clicks, tags), profiles.keyword_profile(clicks, tags, 16)
    weights = lambda df: Counter(tuple(r) for r in df.select("user_id", "term", "weight").collect())
    assert weights(dealt) == weights(plain)
    shuffles = lambda df: (lambda p: p[p.index("Physical Plan") :].count("Exchange "))(df._jdf.queryExecution().toString())
    assert shuffles(profiles.profile_maps(dealt)) == shuffles(dealt) < shuffles(profiles.profile_maps(plain))
    read = lambda df: Counter((r.user_id, r.part, *sorted(r.profile.items())) for r in df.collect())
    everyone = clicks.select("user_id")
    assert read(profiles.profile_maps(dealt, everyone)) == read(everyone.distinct().join(profiles.profile_maps(plain), "user_id", "left").fillna(0, ["part"]).withColumn("profile", F.coalesce("profile", F.expr("cast(map() as map<string,double>)"))))
    some = everyone.where("user_id IN (2, 50)")  # others have a profile but are not asked for
    assert {r.user_id for r in profiles.profile_maps(dealt, some).collect()} == {2, 50}


def test_half_life_and_slot_boost(frame, at):
    clicks = frame([(1, 5, at(0)), (1, 6, at(24)), (1, 7, at(34))], CLICKS)
    tags = frame([(5, "a", 1.0), (6, "a", 1.0), (7, "b", 1.0)], TAGS)
    now = F.lit(at(48)).cast("timestamp_ntz")
    faded = {r["term"]: r["weight"] for r in profiles.decayed_profile(clicks, tags, now).collect()}
    assert math.isclose(faded["a"], 0.25 + 0.5) and math.isclose(faded["b"], 2 ** (-14 / 24))
    boosted = {r["term"]: r["weight"] for r in profiles.slot_boosted_profile(clicks, tags, now).collect()}
    assert math.isclose(boosted["a"], 2 * 1.1) and boosted["b"] == 1.0


# --- ranking --------------------------------------------------------------------


def test_gravity_ranks_newer_articles_first(frame, at, rows):
    known = frame([(n, at(n), 1) for n in (1, 2, 3)] + [(9, at(0), 2)], "news_id long, publish_ts timestamp_ntz, category int")
    now = F.lit(at(30)).cast("timestamp_ntz")
    ranked = ranking.rank_in_category(ranking.gravity_scores(known, now))
    assert rows(ranked, "category", "rank", "news_id") == [(1, 1, 3), (1, 2, 2), (1, 3, 1), (2, 1, 9)]


@pytest.mark.parametrize("age", [-5, -2, -1, 0])
def test_gravity_of_articles_from_the_future(frame, at, rows, age):
    known = frame([(1, at(30 - age), 1), (2, at(0), 1)], "news_id long, publish_ts timestamp_ntz, category int")
    ranked = ranking.rank_in_category(ranking.gravity_scores(known, F.lit(at(30)).cast("timestamp_ntz")))
    assert rows(ranked, "rank", "news_id") == [(1, 1), (2, 2)]
    assert all(0 < r.gravity < 1 for r in ranked.collect())


def test_preference_columns_come_from_the_data(frame):
    shares = frame([(1, 0, 0.5), (1, 10, 0.25), (1, 72, 0.25), (1, 9, 0.0)], "user_id long, category int, share double")
    wide = profiles.preference_matrix(shares)
    assert wide.columns == ["user_id", "cat_0", "cat_10", "cat_72", "cat_9"]
    assert profiles.nonzero_preferences(wide).count() == 3


def test_whole_lists_of_new_articles_keep_no_pairs(frame):
    """Ranks follow from places in the categories, also of a liking or an article that comes twice."""
    likes = [(1, 7, 0.5), (1, 3, 0.5), (1, 9, 0.2), (2, 9, 0.4), (2, 9, 0.4), (2, 3, 0.6), (None, 7, 0.3), (None, 3, 0.1), (3, 8, 1.0), (3, 7, 0.0), (4, None, 1.0), (5, 7, 0.2), (5, 3, 0.4), (5, 7, 0.9)]
    news = [(n, (3, 7, 9, None)[n % 4]) for n in range(40)] + [(4, 3), (None, 9)]
    shares, fresh = frame(likes, "user_id long, category int, share double"), frame(news, "news_id long, category int")
    found = ranking.recommend_new(fresh, shares, n=None)
    assert "Window" not in found._jdf.queryExecution().toString()
    want = Counter()
    for user in {u for u, _, _ in likes}:
        pairs = [(-s, c, n or -1, n) for u, c, s in likes if u == user and s for n, k in news if k == c and c is not None]
        want.update((user, n, c, i + 1) for i, (_, c, _, n) in enumerate(sorted(pairs, key=lambda p: p[:3])))
    read = lambda df: Counter(tuple(r) for r in df.select("user_id", "news_id", "category", "rank").collect())
    assert read(found) == want
    assert read(ranking.recommend_new(fresh, shares, 5, None)) == Counter({r: k for r, k in want.items() if r[3] >= 5})


def brute_overlap(user, article):
    """Weight of the tags that both have, as a part of the weight of all tags of both."""
    both = user.keys() & article.keys()
    shared = sum(user[t] + article[t] for t in both)
    differing = sum(side[t] for side in (user, article) for t in side.keys() - both)
    return (shared + 1e-6) / (shared + differing + 1e-6)


def as_rows(weights):
    return [(k, t, w) for k, tags in weights.items() for t, w in tags.items()]


def test_overlap_of_one_shared_tag(frame):
    profile = frame(as_rows({1: {"a": 2.0, "b": 1.0}}), "user_id long, term string, weight double")
    tags = frame(as_rows({5: {"a": 3.0, "c": 4.0}}), TAGS)
    (only,) = ranking.recommend_by_overlap(profile, tags).collect()
    assert math.isclose(only["score"], 5.000001 / 10.000001)
    (counts,) = ranking.overlap_counts(profile, tags).collect()
    assert (counts["n_shared"], counts["n_differing"]) == (1, 2)
    assert math.isclose(counts["s2"], 5.0)


@pytest.mark.parametrize("block", [64, 2])
def test_overlap_lists_equal_brute_force(frame, monkeypatch, block):
    """All articles are scored for all users; lists that run short are padded."""
    monkeypatch.setattr(ranking, "LIST_BLOCK", block)
    random.seed(3)
    tags = "abcdefghijklmnopqrstuvwxyz"

    def some(names, most):
        return {t: round(random.uniform(0.1, 2), 3) for t in random.sample(names, random.randint(1, most))}

    users = {u: some(tags[:20], 8) for u in range(1, 30)} | {30: {"z": 1.0}, 31: {"nowhere": 1.0}}
    news = {n: some(tags, 5) for n in range(100, 130)}
    profile = frame(as_rows(users), "user_id long, term string, weight double")
    keywords_ = frame(as_rows(news), TAGS)
    got = defaultdict(dict)
    for r in ranking.recommend_by_overlap(profile, keywords_, 10).collect():
        got[r["user_id"]][r["rank"]] = (r["news_id"], r["score"])
    assert got.keys() == users.keys()
    for u, user in users.items():
        scored = sorted(
            ((brute_overlap(user, a), n) for n, a in news.items()), key=lambda s: (-s[0], -s[1])
        )[:10]
        mine = [got[u][i + 1] for i in range(10)]
        assert all(math.isclose(m[1], s[0], rel_tol=1e-9) for m, s in zip(mine, scored))
        assert len({n for n, _ in mine}) == 10
        assert all(0 <= s <= 1 + 1e-12 for _, s in mine)  # sums differ in order


def test_most_pairs_are_never_made(spark, frame, monkeypatch):
    """Lists equal brute force while far fewer pairs are scored than there are."""
    monkeypatch.setattr(ranking, "LIST_BLOCK", 8)
    random.seed(9)
    weight = {f"t{i}": 6.0 / (1 + i) ** 0.7 for i in range(300)}  # heavy keywords that many read, light ones

    def some(n, most):
        return {t: round(weight[t] * random.uniform(0.8, 1.2), 4) for t in random.sample(sorted(weight)[:most], n)}

    users, news = {u: some(90, 100) for u in range(40)}, {a: some(20, 300) for a in range(1000, 1400)}
    profile, tags = frame(as_rows(users), "user_id long, term string, weight double"), frame(as_rows(news), TAGS)
    got = defaultdict(list)
    for r in ranking.recommend_by_overlap(profile, tags, 10).orderBy("rank").collect():
        got[r["user_id"]].append(r["news_id"])
    for u, user in users.items():
        scored = sorted(((-round(brute_overlap(user, a), 9), -n) for n, a in news.items()))[:10]
        assert got[u] == [-n for _, n in scored]
    with_totals = ranking._with_news_totals(tags).withColumnRenamed("weight", "tag_weight")
    made = ranking.overlap_candidates(profile, with_totals, 10).count()
    overlapping = sum(1 for u in users.values() for a in news.values() if u.keys() & a.keys())
    assert overlapping > 15_000 and made < overlapping / 3


def test_read_articles_can_be_left_out(frame, rows):
    profile = frame(as_rows({1: {"a": 1.0}}), "user_id long, term string, weight double")
    tags = frame(as_rows({5: {"a": 1.0}, 6: {"a": 2.0}, 7: {"b": 3.0}}), TAGS)
    read = frame([(1, 6), (1, 6), (2, 5)], "user_id long, news_id long")
    got = ranking.recommend_by_overlap(profile, tags, read=read)
    assert rows(got, "news_id", "rank") == [(5, 1), (7, 2)]


def test_lists_of_empty_profiles_and_articles_without_keywords(frame, rows):
    profile = frame(as_rows({1: {"a": 1.0}}), "user_id long, term string, weight double")
    tags = frame(as_rows({5: {"a": 1.0}, 6: {"b": 2.0}, 7: {"b": 3.0}}), TAGS)
    articles = frame([(n,) for n in (5, 6, 7, 8)], "news_id long")
    users = frame([(1,), (2,), (2,)], "user_id long")
    read = frame([(2, 8)], "user_id long, news_id long")
    got = ranking.recommend_by_overlap(profile, tags, 3, read, articles, users)
    assert rows(got, "user_id", "rank", "news_id") == [
        (1, 1, 5), (1, 2, 8), (1, 3, 6), (2, 1, 5), (2, 2, 6), (2, 3, 7),
    ]


def test_lists_by_preference_equal_the_head_of_the_whole_order(frame):
    random.seed(5)
    scored = frame([(c, 100 * c + i, random.choice([0.1, 0.2, 0.4])) for c in range(4) for i in range(30)], "category int, news_id long, gravity double")
    shares = frame([(u, c, s) for u in range(9) for c, s in ((u % 4, 0.5), ((u + 1) % 4, 0.25), ((u + 2) % 4, 0.25))], "user_id long, category int, share double")
    head = {(r["user_id"], r["rank"]): r["news_id"] for r in ranking.recommend_by_preference(shares, scored, 10).collect()}
    page = {(r["user_id"], r["rank"]): r["news_id"] for r in ranking.user_score_page(shares, scored, 25, 20).collect()}
    whole = {(r["user_id"], r["rank"]): r["news_id"] for r in ranking.user_score_order(shares, scored).collect()}
    assert len(head) == 90 and len(whole) == 9 * 90
    assert all(whole[k] == v for k, v in head.items())
    assert page == {k: v for k, v in whole.items() if 25 <= k[1] < 45}


def test_new_articles_come_in_pages(frame, rows):
    fresh = frame([(n, n % 2) for n in range(20)], "news_id long, category int")
    shares = frame([(1, 0, 0.7), (1, 1, 0.3), (2, 1, 1.0), (2, 0, 0.0)], "user_id long, category int, share double")
    got = ranking.recommend_new(fresh, shares, 9, 4)
    assert rows(got, "user_id", "rank", "news_id") == [
        (1, 9, 16), (1, 10, 18), (1, 11, 1), (1, 12, 3), (2, 9, 17), (2, 10, 19),
    ]


# --- classes and clusters ---------------------------------------------------------


def test_bayes_equals_spark_ml(spark, frame):
    random.seed(1)
    terms = [f"t{i}" for i in range(12)]
    docs = {d: {t: random.randint(1, 4) for t in random.sample(terms, 5)} for d in range(40)}
    labels = {d: d % 3 for d in docs}
    cells = frame(as_rows(docs), "news_id long, term string, n long")
    truth = frame(list(labels.items()), "news_id long, label int")
    marked = bayes.labelled_cells(cells, truth)
    got = bayes.predict(truth, cells, bayes.term_table(marked, truth), bayes.label_table(marked, truth))
    vectors = spark.createDataFrame(
        [(d, float(labels[d]), Vectors.dense([float(docs[d].get(t, 0)) for t in terms])) for d in docs],
        ["news_id", "label", "features"],
    )
    model = NaiveBayes(smoothing=1.0).fit(vectors)
    raw = {r["news_id"]: (int(r["prediction"]), max(r["rawPrediction"])) for r in model.transform(vectors).collect()}
    for r in got.collect():
        assert r["label"] == raw[r["news_id"]][0]
        assert math.isclose(r["score"], raw[r["news_id"]][1], rel_tol=1e-9)


def test_articles_without_known_terms_get_the_most_common_label(frame, rows):
    cells = frame([(1, "a", 1), (2, "b", 1), (3, "b", 1)], "news_id long, term string, n long")
    truth = frame([(1, "x"), (2, "y"), (3, "y")], "news_id long, label string")
    marked = bayes.labelled_cells(cells, truth)
    new = frame([(8,), (9,)], "news_id long")
    fresh = frame([(8, "a", 2), (9, "unknown", 5)], "news_id long, term string, n long")
    got = bayes.predict(new, fresh, bayes.term_table(marked, truth), bayes.label_table(marked, truth))
    assert rows(got, "news_id", "label") == [(8, "x"), (9, "y")]


def test_sparse_k_means_equals_dense_steps(frame):
    random.seed(2)
    terms = [f"t{i}" for i in range(9)]
    docs = {d: {t: random.randint(1, 5) for t in random.sample(terms, 4)} for d in range(40)}
    cells = frame(as_rows(docs), "news_id long, term string, n long")
    k = 3
    seeds = [r["news_id"] for r in clusters.seeds(cells.select("news_id").distinct(), "news_id", k).orderBy("cluster").collect()]
    dense = {d: [docs[d].get(t, 0) for t in terms] for d in docs}
    centres = [dense[s] for s in seeds]

    def nearest():
        return {d: min(range(k), key=lambda i: (round(sum((a - b) ** 2 for a, b in zip(v, centres[i])), 9), i)) for d, v in dense.items()}

    for _ in range(3):
        groups = nearest()
        for i in range(k):
            members = [dense[d] for d in dense if groups[d] == i]
            centres[i] = [sum(c) / len(members) for c in zip(*members)] if members else centres[i]
    got = {r["news_id"]: r["cluster"] for r in clusters.cluster_articles(cells, k).collect()}
    assert got == nearest()


def test_dense_k_means_equals_plain_rounds(frame):
    random.seed(7)
    vectors = {i: [round(random.gauss(3 * (i % 4), 1), 3) for _ in range(5)] for i in range(80)} | {900: [99.0] * 5, 901: [99.0] * 5}
    table = frame(list(vectors.items()), "vec_id long, embedding array<float>")
    seeded = [r["vec_id"] for r in clusters.seeds(table, k=5).orderBy("cluster").collect()]
    plain = {i: [float(np.float32(x)) for x in v] for i, v in vectors.items()}
    centres = [plain[i] for i in seeded]
    for steps in range(1, 30):
        groups = {i: min(range(5), key=lambda c: (round(math.dist(v, centres[c]) ** 2, 9), c)) for i, v in plain.items()}
        means = [[v for i, v in plain.items() if groups[i] == c] for c in range(5)]
        after = [[sum(x) / len(m) for x in zip(*m)] if m else centres[c] for c, m in enumerate(means)]
        moved = max(map(math.dist, centres, after))
        centres = after
        if steps == 2 or moved <= 0.01:
            got = clusters.lloyd(table, 5, steps).orderBy("cluster").collect()
            assert all(math.dist(r["embedding"], c) < 1e-9 for r, c in zip(got, centres)) and len(got) == 5
        if moved <= 0.01:
            break
    longer = clusters.lloyd(table, 5, 40).orderBy("cluster").collect()  # stops by itself
    assert all(math.dist(r["embedding"], c) < 1e-9 for r, c in zip(longer, centres))
    assert clusters.lloyd(table.limit(0), 5).count() == 0


def test_vocabulary_ids_never_move(frame, rows):
    first = matrix.vocabulary(frame([(1, "m"), (1, "c"), (2, "m")], "news_id long, term string"))
    more = frame([(3, "a"), (3, "m"), (4, "z"), (4, "a")], "news_id long, term string")
    grown = matrix.extended_vocabulary(first, more)
    assert rows(grown, "term_id", "term") == [(0, "c"), (1, "m"), (2, "a"), (3, "z")]
    assert rows(matrix.extended_vocabulary(grown, more), "term_id") == [(i,) for i in range(4)]
    assert rows(matrix.extended_vocabulary(grown.limit(0), more), "term_id", "term") == [(0, "a"), (1, "m"), (2, "z")]


def test_an_empty_cluster_keeps_its_centre(frame):
    """A cluster that never had a seed takes nobody.

    Equal seeds (a: 1) first give all to cluster 0, whose mean (a: 38/39,
    b: 5/39) is then further from the 38 than the centre that cluster 1 kept.
    """
    cells = frame([(d, "a", 1) for d in range(38)] + [(99, "b", 5)], "news_id long, term string, n long")
    seeded = {r["news_id"] for r in clusters.seeds(cells.select("news_id").distinct(), "news_id", 2).collect()}
    assert 99 not in seeded
    got = {r["news_id"]: r["cluster"] for r in clusters.cluster_articles(cells, 2).collect()}
    assert got == {**{d: 1 for d in range(38)}, 99: 0}
    few = {r["news_id"]: r["cluster"] for r in clusters.cluster_articles(cells.where("news_id > 36"), 5).collect()}
    assert len(few) == 2 and set(few.values()) == {0, 1}


def test_label_index(frame, rows):
    labels = frame([(1, "b"), (2, "a"), (3, "b")], "news_id long, label string")
    assert rows(bayes.label_index(labels), "index", "label") == [(0, "a"), (1, "b")]
