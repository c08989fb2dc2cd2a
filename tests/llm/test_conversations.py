"""The conversation trie against a plain one built of tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import conversations
from broadsheet.llm.queries import QUERIES, SQL
from check import database, difference

SCHEMA = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.001"


def plain_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: tuple(v for _, v in sorted(t, key=lambda x: x[0])) for c, t in turns.items()}
    rebuilt, members, children = {}, defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - (c % 5 if c >= 0 else -(-c % 5)), ())[:h] + own[c][h:]
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        below = [out[k] for k in children[p]]
        saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        ends = ",".join(str(c) for c in sorted(members[p]) if len(rebuilt[c]) == len(p))
        out[p] = (
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below),
            sum(b[5] for b in below) or 1, saved + sum(b[6] for b in below), hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def trie(frame):
    return sorted((tuple(r) for r in conversations.prefix_trie(frame).collect()), key=str)


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    rows = []
    for c in [*range(-12, 60), 10**12, None]:
        for turn in range(rng.choice([0, 1, 2, 3, 9, 12])):
            role, text = rng.choice(["user", "tool", None]), rng.choice(["x", "yé", None, "", "x" * 50])
            rows.append((c, turn if rng.random() < 0.9 else None, role, text))
    return rows + rows[:5]  # repeated rows are turns of their own


def test_trie_of_nulls_ties_and_repeats(frame, turns):
    assert trie(frame(turns, SCHEMA)) == plain_trie(turns)


def test_long_lists_and_long_conversations(frame, monkeypatch):
    """Many equal conversations, a very long one, a very long text."""
    monkeypatch.setattr(conversations, "PIECE_IDS", 7)
    same = [(c, t, "user", f"t{t}") for c in range(0, 200) for t in range(2)]
    long = [(1000, t, "user", str(t % 3)) for t in range(3000)] + [(1001, t, "user", str(t % 3)) for t in range(2999)]
    rows = same + long + [(5000, 0, "user", "é" * 1_000_000), (5001, 0, "user", "é" * 1_000_000)]
    assert trie(frame(rows, SCHEMA)) == plain_trie(rows)


def test_empty_table_and_further_columns(frame, turns):
    assert trie(frame([], SCHEMA)) == []
    few = [r for r in turns if r[0] is not None and 0 <= r[0] < 15]
    clashing = frame(few, SCHEMA)
    for name in ("place", "node", "_bytes", "_digest", "depth", "_salt", "_part"):
        clashing = clashing.withColumn(name, F.lit(1))
    assert trie(clashing) == plain_trie(few)


def test_query_equals_sql(spark):
    ours = QUERIES["op12_conversation_trie"](spark, SF).toPandas().astype({"parent_conv_id": "Int64"})
    assert len(ours) > 10
    assert difference(ours, database(SF).sql(SQL["op12_conversation_trie"]).df()) == ""
