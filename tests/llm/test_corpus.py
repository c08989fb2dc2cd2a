"""Operators over a whole corpus, against brute force on small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from broadsheet.llm import exact, mixing, passages, simhash, suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def fixture_docs():
    """Overlapping passages, copies, null and empty texts, a repeated row."""
    rng = random.Random(5)
    base = ["".join(rng.choice("ab ") for _ in range(900)) for _ in range(6)]
    docs = []
    for i in range(60):
        text, start = rng.choice(base), rng.randrange(700)
        head = "".join(rng.choice("abc d") for _ in range(rng.randrange(300)))
        docs.append((i, head + text[start : start + rng.randrange(100, 400)] + rng.choice(["", "x" * 300, "é" * 150])))
    return docs + [(100, None), (101, ""), (102, "z" * 1000), (103, docs[3][1]), (104, docs[3][1])]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_exact_groups(frame, rows):
    docs = frame(
        [(1, "a"), (5, "a"), (3, "b"), (None, "c"), (2, "c"), (7, None), (8, ""), (9, "d"), (9, "d"), (4, "a" * 70), (6, "a" * 69 + "b")],
        "doc_id long, text string",
    )
    found = sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(docs).collect())
    assert found == [
        (0, 2, 2, False), (1, 5, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 1, True), (5, 5, 2, True),
        (6, 6, 1, True), (7, 8, 2, False), (8, 8, 2, True), (9, 9, 2, False), (9, 9, 2, True),
    ]
    assert sorted(r.doc_id for r in exact.drop_copies(docs.withColumn("kept", F.lit(1))).collect()) == [2, 3, 4, 5, 6, 8, 9]
    assert exact.exact_groups(docs.limit(0)).count() == exact.drop_copies(docs.limit(0)).count() == 0


CLASHING = ("_salt", "__rows", "__doc", "__k0", "__maybe", "_n", "_id", "_t", "_bucket", "kept", "component_id")


def clashing(docs):
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    return docs


def test_stages_keep_clashing_columns(frame):
    """Copies, near copies and mixing on tables with further columns, nulls and repeated rows."""
    long = " ".join(f"word{i}" for i in range(80))
    rows = [(1, long, "s"), (2, long, "s"), (2, long, "s"), (3, long + " x", "t"), (None, long, "t"), (None, None, None), (4, "", "s"), (5, "other", "t")]
    docs = clashing(frame(rows, "doc_id long, text string, source string"))
    once = exact.drop_copies(docs)
    assert once.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in once.collect()), key=str) == sorted([(2, long), (3, long + " x"), (4, ""), (5, "other")], key=str)
    alone = simhash.representatives(docs)
    assert alone.columns == docs.columns
    kept = {(r.doc_id, r.text) for r in alone.collect()}
    assert alone.count() == len(kept) and (1, long) in kept and (2, long) not in kept and (4, "") in kept and (None, None) not in kept
    mix = mixing.mix(docs)
    assert mix.columns == docs.columns and {r._salt for r in mix.collect()} == {"own _salt"}
    for stage in (exact.drop_copies, simhash.representatives, mixing.mix):
        assert stage(docs.limit(0)).count() == 0


def test_many_sources_meet_their_cuts_by_shuffle(frame, monkeypatch):
    rows = [(i, "w " * (i % 17), None, f"s{i % 5}", 0) for i in range(150)]
    docs = frame(rows, SCHEMA)
    sent = sorted(tuple(r) for r in mixing.mixed(docs).collect())
    monkeypatch.setattr(mixing, "SENT_ROWS", 0)
    assert sorted(tuple(r) for r in mixing.mixed(docs).collect()) == sent


def test_exact_groups_plan_is_small(spark):
    """Levels are stored, so the last plan does not hold those before."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for result in (exact.exact_groups(docs), exact.drop_copies(docs)):
        plan = result._jdf.queryExecution().sparkPlan().toString() + result._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") < 40


def test_losers_move_and_few_others(spark):
    """Rows that are in no group of copies pass the filter by."""
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 1900).cast("string")).alias("text"))
    once = exact.drop_copies(docs)
    assert sorted(r.doc_id for r in once.collect()) == list(range(100, 2000))


@pytest.mark.parametrize("hot", [20_000, 3])
def test_repeated_strings(spark, fixture_docs, hot):
    window, count = 200, Counter()
    data = {d: (t or "").encode() for d, t in fixture_docs}
    for x in data.values():
        count.update(x[i : i + window] for i in range(len(x) - window + 1))
    found = suffixes.without_repeats(spark.createDataFrame(fixture_docs, "doc_id long, text string"), hot=hot)
    found = {r.doc_id: r for r in found.collect()}
    for d, x in data.items():
        gone = bytearray(len(x))
        for i in range(len(x) - window + 1):
            if count[x[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        r = found[d]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(x), sum(gone), len(re.findall(b"\1+", bytes(gone))))
        assert bytes(r.kept_bytes) == bytes(c for c, g in zip(x, gone) if not g)


@pytest.mark.parametrize("hot", [20_000, 2])
def test_repeated_passages(spark, fixture_docs, hot):
    window, first = 5, {}
    words = {d: words_of(t) for d, t in fixture_docs}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    frame = spark.createDataFrame(fixture_docs, "doc_id long, text string")
    found = {r.doc_id: r for r in passages.without_repeats(frame, window=window, phrase=2, hot=hot).collect()}
    for d, own in words.items():
        gone = {j for i in range(len(own) - window + 1) if first[tuple(own[i : i + window])] < d for j in range(i, i + window)}
        assert (found[d].n_words, found[d].n_removed) == (len(own), len(gone))
        assert found[d].kept_text == " ".join(w for i, w in enumerate(own) if i not in gone)


def test_listed_copies(spark):
    """A text with most of the rows is looked at once."""
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(i, text) for i in range(40)] + [(50, "short"), (51, "short")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in passages.without_repeats(docs).collect()) == (
        [(0, 0)] + [(i, 60) for i in range(1, 40)] + [(50, 0), (51, 0)]
    )
    assert {r.n_removed for r in suffixes.without_repeats(docs).where("doc_id < 50").collect()} == {len(text)}


def test_deep_shallow_order():
    rng = random.Random(2)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.choice([2, 40]))).ljust(96, b"a") for _ in range(300)]
    table = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, 96)
    order, prefix = suffixes.deep_shallow(np.ascontiguousarray(table), np.zeros(300, np.int64), shallow=8)
    ranked = [strings[i] for i in order]
    assert ranked == sorted(strings)
    assert prefix[1:].tolist() == [suffixes.common_prefix(a, b) for a, b in zip(ranked, ranked[1:])]


def plain_print(text):
    words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """Smallest index reachable over pairs that differ in two bits at most."""
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j, b in enumerate(values[:i]):
                if label[i] != label[j] and (a ^ b).bit_count() <= 2:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_near_duplicates(spark, frame):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE two"), (1004, " ".join(docs[0][1].split()[:-1]))]
    prints = [plain_print(t) for _, t in docs]
    label = plain_components(prints)
    found = simhash.near_duplicates(frame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in found} == {
        d: (p, docs[k][0]) for (d, _), p, k in zip(docs, prints, label)
    }


def test_links_of_crowded_keys(spark):
    """Chains and balls of fingerprints, more than are compared in pairs."""
    rng = random.Random(6)
    values = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(90):
            centre ^= sum(1 << b for b in rng.sample(range(64), 2)) if rng.random() < 0.3 else 0
            values.add(centre ^ sum(1 << b for b in rng.sample(range(10), rng.choice([0, 1, 2, 3]))))
    values = sorted(v - (v >> 63 << 64) for v in values)
    label = plain_components([v & (2**64 - 1) for v in values])
    links = simhash.links(spark.createDataFrame([(v,) for v in values], "fingerprint long"))
    named = {r.node: r.component for r in simhash.components(links).collect()}
    assert {v: named.get(v, v) for v in values} == {v: values[k] for v, k in zip(values, label)}


def test_golay_words_share_a_codeword():
    rng = random.Random(1)
    words = np.array([rng.getrandbits(23) for _ in range(500)])
    for bits in (0, 1, 2):
        other = np.array([w ^ sum(1 << b for b in rng.sample(range(23), bits)) for w in words.tolist()])
        for a, b in zip(simhash.codewords(words), simhash.codewords(other)):
            assert set(a.tolist()) & set(b.tolist())


def test_mixing(frame, spark):
    rng = random.Random(9)
    rows = [(i, " ".join("w" * rng.randrange(1, 30)), None, f"s{rng.randrange(5)}" if i % 9 else None, 0) for i in range(200)]
    rows += [(500, None, None, "s1", 0), (501, "a b c", None, "tiny", 0), (None, "a b", None, "s1", 0), (7, rows[7][1], None, rows[7][3], 0)]
    docs = frame(rows, SCHEMA)
    found = mixing.mixed(docs).collect()
    assert len(found) == len(rows)
    total, by = sum(r.size for r in found), defaultdict(list)
    for r in found:
        by[r.source_size, r.target].append(r)
        assert 0 <= r.taken <= 2 * r.size
    for (size, target), own in by.items():
        assert target <= 2 * size and target - 60 <= sum(r.taken for r in own) <= target
    assert abs(sum(t for _, t in by) - 1.5 * total) < 0.01
    taken = sum(r.taken for r in found)
    again = mixing.mix(docs)
    assert again.columns == docs.columns
    assert sum(len(words_of(r.text)) for r in again.collect()) == taken
    assert mixing.mixed(docs.limit(0)).count() == mixing.mix(docs.limit(0)).count() == 0


def test_pipeline(spark, tmp_path):
    """Each stage against a plain version of it, on its own input."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language ID"](spark, docs.unionByName(docs.limit(1).withColumn("text", F.lit("12 --"))), "")
    assert known.columns == docs.columns and known.count() == docs.count()
    once = stages["exact dedup"](spark, docs, "").collect()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.text].append(r.doc_id)
    assert sorted(r.doc_id for r in once) == sorted(max(v) for v in texts.values())
    alone = stages["SimHash near-dedup"](spark, docs, "").collect()
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    label = plain_components([plain_print(t) for _, t in rows])
    assert sorted(r.doc_id for r in alone) == [rows[i][0] for i in sorted(set(label))]
    result = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and result.count() > 100
    assert hashlib.sha256(b"").hexdigest() not in {r.ids_sha256 for r in result.collect()}


@pytest.mark.parametrize("hot", [20_000, 1])
def test_words_have_no_length_limit(spark, hot):
    def text(name, long):
        return " ".join([f"{name}{i}" for i in range(10)] + [f"w{i}" for i in range(40)] + [long] + [f"v{i}" for i in range(40)])

    big, other = "x" * (2 << 20), "x" * (2 << 20) + "y"
    assert len(set(passages.word_hashes(f"a {big} b {other} {big} a {'z' * (1 << 20)}".encode()).tolist())) == 5
    rows = [(1, text("a", big)), (2, text("b", big)), (3, text("c", other)), (4, big), (5, text("d", "z" * 2000)), (6, text("e", "z" * 2000))]
    found = passages.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in found) == (
        [(1, 91, 0), (2, 91, 81), (3, 91, 0), (4, 1, 0), (5, 91, 0), (6, 91, 81)]
    )
    assert {r.doc_id: r.kept_text for r in found}[4] == big
