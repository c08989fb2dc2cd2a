"""Near-duplicates by MinHash against all pairs of full sets."""

import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import minhash

SCHEMA = "doc_id long, text string"


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def plain_duplicates(rows):
    sets = [plain_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                label[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        d = 2**63 if d is None else d
        least[top(i)] = min(least.get(top(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least[top(i)]
        out.append((d, len(sets[i]), None if c == 2**63 else c, c == (2**63 if d is None else d)))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in minhash.near_duplicates(frame).collect()), key=str)


def changed(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    """Copies with some words changed, chains, short texts, nulls, repeated rows."""
    rng = random.Random(11)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([5, 9, 30, 120, 400]))]
        texts += [changed(rng, base, rng.randrange(max(2, len(base) // 25))) for _ in range(9)]
    chain = [f"c{i}" for i in range(130)]
    texts += [" ".join(chain[i : i + 100]) for i in range(0, 30, 2)]
    texts += ["a", "A", "a b", "a  B", "b a", "a b c d", "a b c d e", "A\tb c\nd e", None, "", " \n ", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + rows[:4] + [(None, texts[0]), (None, "only here " * 9), (None, None), (900, texts[3])]


@pytest.mark.parametrize("cell", [8 << 20, 300])
def test_all_pairs(frame, rows, monkeypatch, cell):
    """Also with lists and blocks over many cells."""
    monkeypatch.setattr(minhash, "CELL_BYTES", cell)
    assert found(frame(rows, SCHEMA)) == plain_duplicates(rows)


@pytest.mark.parametrize("cell", [8 << 20, 20_000])
def test_copies_of_a_hub(frame, monkeypatch, cell):
    """Copies that are close to their original but not to each other, and many alike."""
    monkeypatch.setattr(minhash, "CELL_BYTES", cell)
    rng = random.Random(5)
    base = [f"h{i}" for i in range(60)]
    rows = [(i, changed(rng, base, 1)) for i in range(300)]
    rows += [(300, " ".join(base))] + [(400 + i, "all the same words are here again and again") for i in range(300)]
    expected = plain_duplicates(rows)
    assert {r[2] for r in expected} == {0, 400}
    assert found(frame(rows, SCHEMA)) == expected
    alone = [r for r in rows if r[0] != 300]
    assert found(frame(alone, SCHEMA)) == plain_duplicates(alone)


def test_copies_in_one_cell_take_no_table_of_pairs():
    """A cell of copies that all match holds their forest, not their pairs."""
    copies = 1500
    ids, data = np.arange(copies)[::-1] * 3, [bytes(minhash.COORDINATES)] * copies
    tracemalloc.start()
    a, b = minhash._edges(ids, np.full(copies, 9), data, np.full(copies, 2), minhash.collisions_suffice)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert a.tolist() == list(range(3, 3 * copies, 3)) and not b.any()
    assert most < 60 << 20


def test_forest_of_a_cell_is_that_of_all_its_matches(monkeypatch):
    """Whatever the blocks, with outsiders that stand in the cell twice and copies that hang together early."""
    rng = random.Random(8)
    members = [(i * 5, rng.randrange(40) if i % 3 else 7) for i in range(90)]
    cell = [(i, v, k) for i, v in members for k in rng.choice([(2,), (1,), (0, 1)])]
    rng.shuffle(cell)
    values = np.array([v for _, v, _ in cell])
    alike = lambda a, n, b, m: abs(n[:, None] - m) <= (n[:, None] + m) % 2
    label = {i: i for i, _ in members}
    matching = [(i, j) for i, v, k in cell for j, w, c in cell if k != 1 and c != 0 and abs(v - w) <= (v + w) % 2]
    for _ in members:
        for i, j in matching:
            label[i] = label[j] = min(label[i], label[j])
    want = sorted((i, top) for i, top in label.items() if i != top)
    for rows, columns in ((256, 2048), (3, 5), (1, 1)):
        monkeypatch.setattr(minhash, "_ROWS_AT_ONCE", rows)
        monkeypatch.setattr(minhash, "_COLUMNS_AT_ONCE", columns)
        a, b = minhash._edges(np.array([i for i, _, _ in cell]), values, [b""] * len(cell), np.array([k for *_, k in cell]), alike)
        assert sorted(zip(a.tolist(), b.tolist())) == want


def test_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == plain_duplicates(rows)


def test_shared_passages_are_not_posted(frame):
    """A passage in all documents is no posting list; without near copies there are none."""
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(80))) for i in range(200)]
    signed = minhash.signed_documents(frame(rows, SCHEMA)).withColumn("_id", F.col("doc_id"))
    assert minhash.postings(signed).count() == 0
    assert found(frame(rows, SCHEMA)) == plain_duplicates(rows)


def test_long_texts_go_in_blocks(monkeypatch):
    text = "".join(f"W{i % 977}" + " \n"[i % 3 == 0] for i in range(30_000))
    whole = minhash.shingle_set(text)
    monkeypatch.setattr(minhash, "_BLOCK", 50)
    monkeypatch.setattr(minhash, "_ROWS", 7)
    assert (minhash.shingle_set(text) == whole).all() and len(whole) == len(plain_set(text))
    assert (minhash.signature(whole) == np.array(minhash.signature(whole))).all()


def test_signatures_estimate_similarity():
    rng = random.Random(1)
    agree = []
    for _ in range(200):
        a = [rng.getrandbits(63) for _ in range(90)]
        b = a[:80] + [rng.getrandbits(63) for _ in range(10)]
        x, y = (minhash.signature(np.unique(np.array(s, np.uint64))) for s in (a, b))
        agree.append((x == y).mean())
    assert abs(np.mean(agree) - 0.8) < 0.02 and min(agree) * minhash.COORDINATES >= minhash.MATCHES


def test_empty_table_and_further_columns(frame, rows):
    assert found(frame([], SCHEMA)) == []
    clashing = frame(rows[:60], SCHEMA)
    for name in ("_id", "_set", "_n", "a", "n_shingles", "_salt", "kept"):
        clashing = clashing.withColumn(name, F.lit(1))
    assert found(clashing) == plain_duplicates(rows[:60])
