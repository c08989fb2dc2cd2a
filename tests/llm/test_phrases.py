"""Phrases against counts of every phrase in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from broadsheet.llm import phrases
from broadsheet.llm.queries import QUERIES, SQL
from check import database, difference

SCHEMA = "doc_id long, text string, lang string"
SF = "/root/testdata/sf0.001"


def plain_counts(docs):
    f = defaultdict(Counter)
    for _, text, lang in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return f


def plain_phrases(docs, least=10, first=2000):
    out = []
    for lang, f in plain_counts(docs).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        longer = defaultdict(int)
        for p, c in f.items():
            if len(p) == 3 and c >= least:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], c)
        scored = []
        for p, a in f.items():
            if len(p) > 1 and a >= least and 100 * longer[p] < 50 * a:
                score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def mined(frame, **options):
    return sorted(tuple(r) for r in phrases.collocations(frame, **options).collect())


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(4)
    words = ["a", "B", "cé", "Ünter", "d\x1c", "e f", "the", "#"]
    made = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "\x0b", "!"]) for _ in range(rng.randrange(60)))
        made.append((i if i % 9 else None, text, rng.choice(["en", "fr", None, "und"])))
    return made + made[:20] + [(500, None, "en"), (501, "", "xx"), (502, " ?! ", None)]


@pytest.mark.parametrize("sample,lowered", [(0.25, 2), (0.1, 3), (0.0, 1), (1.0, 1)])
def test_phrases_whatever_the_sample(frame, docs, sample, lowered):
    expected = plain_phrases(docs)
    assert len(expected) > 60
    assert mined(frame(docs, SCHEMA), sample=sample, lowered=lowered) == expected
    assert mined(frame(docs, SCHEMA), sample=sample, lowered=lowered, least=3, first=7) == plain_phrases(docs, 3, 7)


def test_full_filters_change_nothing(frame, docs, monkeypatch):
    """Filters of one bitmap only, over more phrases than they tell apart."""
    monkeypatch.setattr(phrases, "WORD_BITS", 1 << 15)
    monkeypatch.setattr(phrases, "PAIR_BITS", 1 << 15)
    many = docs + [(1000 + i, " ".join(f"w{(i * j) % 4001} w{j}" for j in range(300)), "en") for i in range(60)]
    assert mined(frame(many, SCHEMA)) == plain_phrases(many)


def test_border_is_counted_exactly(frame, docs):
    """Every frequent phrase, and no count too many over the passes."""
    found = phrases.frequent_phrases(frame(docs, SCHEMA), sample=0.05, lowered=4).where("words > 0").collect()
    expected = {(lang, " ".join(p)): c for lang, f in plain_counts(docs).items() for p, c in f.items() if c >= 10}
    assert len(found) == len(expected) and {(r.lang, r.phrase): r.n for r in found} == expected


@pytest.mark.parametrize("sample,lowered", [(0.0, 1), (0.25, 2), (0.1, 6)])
def test_one_further_pass_closes_the_border(frame, docs, monkeypatch, sample, lowered):
    """Words, pairs and phrases of three that the sample missed, one on the other, in one pass over all texts."""
    passes, counts = [], phrases.counts
    monkeypatch.setattr(phrases, "counts", lambda *given, **named: passes.append(1) or counts(*given, **named))
    rare = [(600 + i, f"zeta{i % 3} eta{i % 3} theta the a", "en") for i in range(45)]
    found = phrases.frequent_phrases(frame(docs + rare, SCHEMA), sample=sample, lowered=lowered).where("words > 0").collect()
    expected = {(lang, " ".join(p)): c for lang, f in plain_counts(docs + rare).items() for p, c in f.items() if c >= 10}
    assert expected["en", "zeta1 eta1 theta"] == 15 and expected["en", "theta the a"] == 45
    assert len(found) == len(expected) and {(r.lang, r.phrase): r.n for r in found} == expected
    assert len(passes) <= 3  # sample, all texts, and once more


def test_long_texts_go_in_blocks(frame, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 64)
    rng = random.Random(8)
    long = "".join(rng.choice(["ab", "c", "x" * 100]) + rng.choice([" ", " ", " ", "\n"]) for _ in range(5000))
    rows = [(1, long, "en"), (2, "ab c ab", "en"), (3, "y" * 500, "en")]
    assert mined(frame(rows, SCHEMA)) == plain_phrases(rows)


def test_scores_are_exact(spark):
    """Counts whose products pass 64 bits."""
    text = " div ".join(
        ["(cast(1000000 AS decimal(7,0)) * cast(a AS decimal(15,0)) * cast(a AS decimal(15,0)))", "(cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"]
    )
    rows = [(10**12 + 7, 10**12 + 9, 10**12 + 8), (999_999_999_999, 10**14 + 3, 10**12), (10, 10, 10)]
    found = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", F.expr(text).alias("s")).collect()
    assert all(s == 10**6 * a * a // (left * right) for a, left, right, s in found)


def test_pair_hashes_are_those_of_spark(spark):
    words = ["a", "é", "long word", ""]
    hashes = np.array([xxhash.xxh64_intdigest(w.encode(), 42) for w in words], np.uint64)
    ours = phrases.pair_hashes(hashes, hashes[::-1]).tolist()
    frame = spark.createDataFrame(list(zip(words, words[::-1])), "a string, b string")
    assert ours == [r.h for r in frame.select(F.xxhash64(F.xxhash64("a"), F.xxhash64("b")).alias("h")).collect()]


def test_empty_tables_and_further_columns(frame, docs):
    assert mined(frame([], SCHEMA)) == []
    clashing = frame(docs, SCHEMA)
    for name in ("words", "phrase", "n", "k", "_salt", "_in", "a"):
        clashing = clashing.withColumn(name, F.lit(1))
    assert mined(clashing) == plain_phrases(docs)


def test_query_equals_sql(spark):
    ours = QUERIES["op11_collocations"](spark, SF).toPandas()
    assert len(ours) > 10
    assert difference(ours, database(SF).sql(SQL["op11_collocations"]).df()) == ""
