"""Counting, choosing and pairing where an article's rows lie together, against plain Python."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import keywords, overlap, ranking


def test_counts_hold_one_article_at_a_time():
    """An article that goes on over batches is given once; others are given as soon as they end."""
    tokens = [(d, 7, t) for d in range(50) for t in ("a", "b", "a", "c", "a", "b", "d")]
    taken = []

    def batches():
        for i in range(0, len(tokens), 10):
            taken.append(i)
            ids, sizes, terms = zip(*tokens[i : i + 10])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sizes), pa.array(terms)], ["news_id", "n_terms", "term"])

    got = keywords._counted(batches())
    first = next(got)
    assert len(taken) < 3
    rows = [r for b in [first, *got] for r in b.to_pylist()]
    assert len(rows) == 200
    assert Counter((r["term"], r["n"]) for r in rows) == {("a", 3): 50, ("b", 2): 50, ("c", 1): 50, ("d", 1): 50}


def test_articles_cut_by_batches_are_counted_whole():
    """Arrow gives groups in no certain order; an article's rows still come once and together."""
    random.seed(8)
    tokens = [(d, 9, f"w{random.randint(0, 900)}") for d in range(400) for _ in range(random.randint(1, 900))]
    cut = [tokens[i : i + 10_000] for i in range(0, len(tokens), 10_000)]
    batches = (pa.RecordBatch.from_pylist([{"news_id": d, "n_terms": n, "term": t} for d, n, t in c]) for c in cut)
    rows = [r for b in keywords._counted(batches) for r in b.to_pylist()]
    assert Counter({(r["news_id"], 9, r["term"]): r["n"] for r in rows}) == Counter(tokens)
    assert len(rows) == len({*tokens})
    ids = [r["news_id"] for r in rows]
    assert sum(a != b for a, b in zip(ids, ids[1:])) == 399


def test_counts_of_an_id_that_repeats(frame, rows):
    news = frame([(1, "a b"), (1, "b c"), (1, "b"), (None, "a"), (None, "a"), (2, None)], "news_id long, content string")
    got = Counter(tuple(r) for r in keywords.term_counts(news).collect())
    assert got == Counter([(1, 2, "a", 1), (1, 2, "b", 2), (1, 2, "c", 1), (1, 1, "b", 1), (None, 1, "a", 2)])


@pytest.mark.parametrize("buckets", [1 << 20, 4])
def test_contenders_have_the_heaviest_terms(frame, monkeypatch, buckets):
    monkeypatch.setattr(keywords, "FREQUENCY_BUCKETS", buckets)
    random.seed(4)
    weights = [1 / (i + 1) for i in range(200)]
    texts = [(d, " ".join(f"w{i}" for i in random.choices(range(200), weights, k=120))) for d in range(60)]
    news = frame(texts, "news_id long, content string")
    df, counts, docs = keywords.text_frequency(news, dealt=False), keywords.term_counts(news), F.lit(60)
    some = keywords.contenders(counts, df, docs, 5)
    read = lambda c: sorted(tuple(r) for r in keywords.top_keywords(keywords.tfidf(c, docs, df), 5).select("news_id", "rank", "term").collect())
    assert read(some) == read(counts)
    if buckets > 4:
        assert some.count() < counts.count() / 4


@pytest.mark.parametrize("rows_of_a_cell", [20_000, 40])
def test_pairs_of_a_grid_of_cells(frame, monkeypatch, rows_of_a_cell):
    """Every pair that shares a keyword comes once, and no row of a pair is shuffled."""
    monkeypatch.setattr(overlap, "CELL_ROWS", rows_of_a_cell)
    random.seed(6)
    some = lambda n: random.sample("abcdefghijklmnopqrstuvwxyz", n)
    users, news = {u: some(6) for u in range(40)}, {a: some(3) for a in range(90)}
    profile = frame([(u, t, 1.0) for u, ts in users.items() for t in ts] + [(None, "a", 1.0)], "user_id long, term string, weight double")
    tags = frame([(a, t, 2.0) for a, ts in news.items() for t in ts], "news_id long, term string, weight double")
    found = ranking.overlap_counts(profile, tags)
    plan = found._jdf.queryExecution().toString()
    assert plan[plan.index("Physical Plan") :].count("Exchange") == 1
    got = {(r.user_id, r.news_id): (r.n_shared, r.n_differing, round(r.s1, 4), round(r.s2, 4)) for r in found.collect()}
    want = {}
    for u, ts in users.items():
        for a, others in news.items():
            if both := len({*ts} & {*others}):
                want[u, a] = (both, 9 - 2 * both, 3.0 * both, 12.0 - 3.0 * both)
    assert got == want and found.count() == len(want)


@pytest.mark.parametrize("sparse, block_users", [(5, 2048), (1, 7), (1000, 7)])
def test_lists_of_common_and_rare_keywords(frame, monkeypatch, sparse, block_users):
    """Tables and lists of keywords give the same lists as brute force, with keywords that come twice or weigh nothing."""
    monkeypatch.setattr(overlap, "SPARSE", sparse)
    monkeypatch.setattr(overlap, "BLOCK_USERS", block_users)
    monkeypatch.setattr(overlap, "CELL_PRODUCTS", 50)
    monkeypatch.setattr(ranking, "LIST_BLOCK", 16)
    random.seed(12)
    names = [f"t{i}" for i in range(60)]
    chance = [1 / (i + 1) for i in range(60)]
    heavy = lambda ts: [(t, round(random.uniform(0.1, 2), 3)) for t in ts]
    users = {u: heavy(random.choices(names, chance, k=12)) for u in range(40)}
    news = {a: heavy({*random.choices(names, chance, k=6)}) for a in range(100, 220)}
    users[40], news[99] = [("zero", 0.0), ("t0", 1.0)], [("zero", 0.5)]
    read = [(u, a) for u in users for a in news if (u + a) % 5 == 0]
    cells = lambda kinds: [(k, t, w) for k, pairs in kinds.items() for t, w in pairs]
    profile, tags = frame(cells(users), "user_id long, term string, weight double"), frame(cells(news), "news_id long, term string, weight double")
    totals = ranking._with_news_totals(tags).withColumnRenamed("weight", "tag_weight")
    found = ranking.overlap_candidates(profile, totals, 4, frame(read, "user_id long, news_id long")).collect()
    got = {u: sorted(((-round(r.score, 9), -r.news_id) for r in found if r.user_id == u))[:4] for u in users}
    for u, mine in users.items():
        scores = []
        for a, its in news.items():
            met = [x + y for s, x in mine for t, y in its if s == t]
            if met and (u, a) not in read:
                whole = sum(w for _, w in mine + its)
                scores.append((-round((1e-6 + sum(met)) / (1e-6 + whole), 9), -a))
        assert got[u] == sorted(scores)[:4]


def test_few_pairs_are_worked_out_exactly(frame, monkeypatch):
    """Of articles that most users share something with, only those near a user's floor are."""
    random.seed(5)
    weight = {f"t{i}": 6.0 / (1 + i) for i in range(80)}
    some = lambda n: [(t, weight[t] * random.uniform(0.5, 1.5)) for t in random.sample(sorted(weight), n)]
    users, worked_out = {u: some(30) for u in range(200)}, []
    news = {a: some(8) for a in range(4000)}

    def batch(kinds, key, other):
        rows = [{key: k, other: None, "terms": [t for t, _ in p], "weights": [w for _, w in p], "news_weight": sum(w for _, w in p), "news_tags": len(p)} for k, p in kinds.items()]
        types = [("user_id", pa.int64()), ("news_id", pa.int64()), ("terms", pa.list_(pa.string())), ("weights", pa.list_(pa.float64())), ("news_weight", pa.float64()), ("news_tags", pa.int64())]
        return pa.RecordBatch.from_pylist(rows, pa.schema(types))

    exact = overlap.Met.exact
    monkeypatch.setattr(overlap.Met, "exact", lambda self, block, place, user: worked_out.append(len(place)) or exact(self, block, place, user))
    readers = overlap.Users([batch(users, "user_id", "news_id")], [])
    run = overlap.Articles(batch(news, "news_id", "user_id"), readers, 0)
    (found,) = overlap.best_pairs(1e-6, 10, 9, 64)([(readers, iter([run]))])
    assert found.num_rows == 2000
    assert sum(worked_out) < 200 * 4000 / 5


def test_only_keywords_of_profiles_are_dealt(frame, monkeypatch):
    """Keywords that no profile has, and articles of such ones alone, are not sent to the cells."""
    kept = {}
    stored = overlap.stored
    monkeypatch.setattr(overlap, "stored", lambda df, name: kept.setdefault(len(kept), stored(df, name)))
    profile = frame([(1, "a", 1.0), (1, "b", 2.0)], "user_id long, term string, weight double")
    tags = frame([(a, t, 1.0) for a in range(50) for t in ("a" if a < 5 else "x", "y", "z")], "news_id long, term string, weight double")
    (row,) = [r for r in ranking.overlap_counts(profile, tags).where("news_id = 3").collect()]
    assert (row.n_shared, row.n_differing, round(row.s2, 5)) == (1, 3, 4.0)
    dealt = [df for df in kept.values() if "news_id" in df.columns]
    assert [r.news_id for df in dealt for r in df.orderBy("news_id").collect()] == [0, 1, 2, 3, 4]


def test_many_rows_of_the_grid_need_no_columns(frame, monkeypatch):
    """Profiles are copied to every column, so there are no more of those than the tasks need."""
    monkeypatch.setattr(overlap, "CELL_ROWS", 1)
    side = frame([(["t"] * 10,)] * 20, "terms array<string>")
    monkeypatch.setattr(overlap, "PROFILE_ROWS", 50)
    assert overlap._grid(side, side) == (8, 8)
    monkeypatch.setattr(overlap, "PROFILE_ROWS", 2)
    assert overlap._grid(side, side) == (100, 1)
