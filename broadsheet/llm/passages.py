"""Repeated passages of words: what also stands in a document of a smaller id is removed.

1. Every window of ``WINDOW`` words has an anchor phrase of ``PHRASE`` words
   (see anchors.py). Phrases that no two documents share are dropped.
2. The pieces of text around the phrases left go to shards by phrase. A shard
   takes each phrase from the document of smallest id that has it, compiles an
   Aho-Corasick automaton of its phrases and streams the pieces of all
   documents through it. At each occurrence the windows around it are confirmed
   by their hash (128 bits) against those of documents of smaller id.
3. The confirmed windows go back to their documents, whose covered words are
   left out.

A phrase that very many pieces share (more than ``HOT``) is not gathered in
one task: its windows are counted by their own hash (128 bits), smallest
doc_id first, combined before the shuffle.

Words have no length limit: in a piece, one of over ``LONG`` bytes is stood for
by its hash (128 bits).

A null text has no words. A null doc_id counts as the largest. Documents of
the same doc_id, or repeated rows, don't remove words from each other.
"""

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.anchors import Copies, Roller, anchor_rows, key_runs, unpacked_places, with_places
from broadsheet.llm.common import count_words, map_columns, whole_text
from broadsheet.plans.skew import salted_join
from broadsheet.plans.storage import stored

WINDOW = 50
PHRASE = 10
#: pieces of a phrase that one task takes: their windows' hashes need some 120 MB
HOT = 20_000
#: bytes of a word that goes into an automaton, which fails on phrases of megabytes
LONG = 1000

_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text in UTF-8."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACES[np.frombuffer(data, np.uint8)]
    turn = np.diff(inside)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word, block by block; a word longer than a block has one of its own."""
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    values, out = np.frombuffer(data, np.uint8), []
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK, side="right")))
        low = int(starts[at])
        if ends[at] - low > _BLOCK:
            out.append(np.array([xxhash.xxh3_64_intdigest(data[low : int(ends[at])])], np.uint64))
            at = stop
            continue
        roller = Roller(values[low : int(ends[stop - 1])].astype(np.uint64))
        out.append(roller.runs(starts[at:stop] - low, ends[at:stop] - low))
        at = stop
    return np.concatenate(out)


_BLOCK = 1 << 20


def _stand_in(word: bytes) -> bytes:
    """The word, or a name of a long one that no word can have."""
    return word if len(word) <= LONG else b"\t" + xxhash.xxh3_128_hexdigest(word).encode()


def _pieces(window: int):
    """Rows of (_key, _d, _r, first window, window range, piece) around the anchors of a text."""

    def rows(_ids, numbers, keys, texts, _listed, found) -> Iterator[tuple]:
        for number, key, text, places in zip(numbers, keys, texts, found):
            words = text.encode("utf-8", "surrogatepass").split()
            for one in places:
                if one["_hot"]:
                    continue
                place, first, last = (int(x) for x in unpacked_places(np.int64(one["_p"])))
                yield one["_h"], number, key, first, place - first, b" ".join(map(_stand_in, words[first : last + window]))

    return rows


def _hot_windows(window: int):
    """Rows of (window hash in two parts, _d, _r, start) for the windows around hot anchors."""

    def rows(_ids, numbers, keys, texts, _listed, found) -> Iterator[tuple]:
        for number, key, text, places in zip(numbers, keys, texts, found):
            words = text.encode("utf-8", "surrogatepass").split()
            for one in places:
                if one["_hot"]:
                    _, first, last = (int(x) for x in unpacked_places(np.int64(one["_p"])))
                    for start in range(first, last + 1):
                        digest = hashlib.md5(b" ".join(words[start : start + window])).digest()
                        yield (*np.frombuffer(digest, np.int64).tolist(), number, key, start)

    return rows


def repeats_in_shard(pieces: list[tuple[int, int, int, int, int, bytes]], window: int, phrase: int) -> Iterator[tuple]:
    """(_d, _r, start, stop) of windows that a document of smaller id has, in words.

    ``pieces`` are sorted by key and doc_id and hold whole keys.
    """
    automaton, phrases = ahocorasick.Automaton(), {}
    cut = [piece.decode("utf-8", "surrogatepass") for *_, piece in pieces]
    split = [text.split(" ") for text in cut]
    for (key, _, _, _, offset, _), words in zip(pieces, split):
        text = f" {' '.join(words[offset : offset + phrase])} "
        if text not in phrases:  # from the document of smallest id
            phrases[text] = len(phrases)
            automaton.add_word(text, (phrases[text], len(text)))
    automaton.make_automaton()
    known: dict[int, int] = {}  # hash of a window, 128 bits -> smallest doc_id
    order = sorted(range(len(pieces)), key=lambda i: pieces[i][1])
    for i in order:
        _, number, row, first, _, data = pieces[i]
        text, words = f" {cut[i]} ", split[i]
        place = {at: nth for nth, at in enumerate(accumulate(map(len, words), lambda at, n: at + n + 1, initial=0))}
        # words of the piece are joined by one space, in bytes too
        starts = [0, *(np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1).tolist(), len(data) + 1]
        wanted: set[int] = set()
        for end, (_, length) in automaton.iter(text):
            at = place[end - length + 1]  # the space before the phrase stands where its first word does in the piece
            wanted.update(range(max(0, at + phrase - window), min(at, len(words) - window) + 1))
        run = None
        for start in sorted(wanted):
            own = xxhash.xxh3_128_intdigest(data[starts[start] : starts[start + window] - 1])
            if known.setdefault(own, number) < number:
                if run and start <= run[1]:
                    run[1] = start + window
                else:
                    if run:
                        yield number, row, first + run[0], first + run[1]
                    run = [start, start + window]
        if run:
            yield number, row, first + run[0], first + run[1]


def _shard(window: int, phrase: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_runs(batches):
            rows = list(zip(*[c.to_pylist() for c in table.columns]))
            if out := list(repeats_in_shard(rows, window, phrase)):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["_d", "_r", "a", "b"])

    return find


def repeated_spans(
    rows: DataFrame, texts: DataFrame, window: int = WINDOW, phrase: int = PHRASE, hot: int = HOT
) -> DataFrame:
    """_d, _r, a, b: words a to b of a row that documents of smaller id have, too; spans may overlap.

    ``texts`` are the ``rows`` dealt by ``_r``.
    """
    found = stored(anchor_rows(rows, word_hashes, window, phrase), "anchors")
    shared = stored(
        found.groupBy("_h")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_d").alias("_low"), F.max("_d").alias("_high"))
        .where("_low < _high")
        .select("_h", (F.col("_n") > hot).alias("_hot")),
        "shared",
    )
    placed = with_places(texts, found.join(shared, "_h"))
    pieces = map_columns(
        placed, "_key long, _d long, _r long, first long, offset long, piece binary", _pieces(window), most=1 << 20
    )
    spans = (
        pieces.repartition("_key").sortWithinPartitions("_key", "_d").mapInArrow(_shard(window, phrase), "_d long, _r long, a long, b long")
    )
    if shared.where("_hot").isEmpty():
        return spans
    # in one plan with the pieces, so that the texts dealt by _r are used again
    windows = map_columns(
        placed.where(F.exists("_found", lambda x: x["_hot"])),
        "w1 long, w2 long, _d long, _r long, a long", _hot_windows(window), most=1 << 20,
    )
    firsts = (
        windows.groupBy("w1", "w2")
        .agg(F.min("_d").alias("_low"), F.max("_d").alias("_high"), F.count(F.lit(1)).alias("_n"))
        .where("_low < _high")
    )
    again = salted_join(windows, firsts.select("w1", "w2", "_low"), ["w1", "w2"], firsts, "_n", ["_r", "a"])
    return spans.unionByName(again.where("_d > _low").select("_d", "_r", "a", (F.col("a") + window).alias("b")))


def covered(spans: list[tuple[int, int]], n: int) -> np.ndarray:
    """Which of n places the spans cover."""
    change = np.zeros(n + 1, np.int64)
    if spans:
        starts, stops = (np.minimum(np.array(c, np.int64), n) for c in zip(*spans))
        np.add.at(change, starts, 1)
        np.add.at(change, stops, -1)
    return np.cumsum(change)[:-1] > 0


def _kept(keep_text: bool):
    def rows(doc_ids, numbers, _rows, texts, _listed, spans) -> Iterator[tuple]:
        for doc_id, number, text, own in zip(doc_ids, numbers, texts, spans):
            words = text.encode("utf-8", "surrogatepass").split()
            gone = covered([(s["a"], s["b"]) for s in own or [] if s["_d"] == number], len(words))
            kept = b" ".join([words[i] for i in np.flatnonzero(~gone)]) if gone.any() else b" ".join(words)
            last = kept.decode("utf-8", "surrogatepass") if keep_text else hashlib.sha256(kept).hexdigest()
            yield doc_id, len(words), int(gone.sum()), last

    return rows


def without_repeats(
    docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, hot: int = HOT, keep_text: bool = True
) -> DataFrame:
    """doc_id, n_words, n_removed and the words kept, as text or as its SHA-256 (kept_sha256)."""
    copies = Copies(docs, count_words(whole_text()), window)
    texts = copies.rows.repartition("_r")
    spans = (
        repeated_spans(copies.rows, texts, window, phrase, hot)
        .groupBy("_r")
        .agg(F.collect_set(F.struct("_d", "a", "b")).alias("_spans"))
    )
    name = "kept_text" if keep_text else "kept_sha256"
    looked_at = map_columns(
        texts.join(spans, "_r", "left").select("doc_id", "_d", "_r", "text", "_listed", "_spans"),
        f"doc_id long, n_words long, n_removed long, {name} string", _kept(keep_text), most=1 << 20,
    )
    # copies of a text that a document of smaller id has, of a window or more: nothing is left
    empty = F.lit("") if keep_text else F.sha2(F.lit(""), 256)
    others = copies.others.select(
        "doc_id", F.col("_size").alias("n_words"), F.col("_size").alias("n_removed"), empty.alias(name)
    )
    return looked_at.unionByName(others)
