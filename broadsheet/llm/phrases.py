"""Phrases of two and three words that stick together, mined after Toivonen.

A sample of the documents proposes words and pairs, at a lowered bound. One
pass over all documents counts every phrase whose parts (its words, or the two
pairs of a phrase of three) are all proposed: these are the proposals and their
negative border, and their counts are exact. Border phrases that turn out
frequent are failures: they join the proposals, and a further pass counts what
they add to the border, and only that. In that pass every pair with a word that
failed stands for proposed, as it was not counted before, so phrases of three
words that need it are counted along. Words are all counted by the first pass
and pairs by the second, so nothing is left that fails, and the result does not
depend on the sample.

Proposals are held as bit filters of fixed size, sent to all tasks. A filter
may take a phrase for proposed that is not; it is then counted, exactly, for
nothing. Larger corpora fill the filters, which makes the count longer and
changes no result. Tasks count block by block with arrays and give one row for
each phrase of a block; Spark sums them up.

Everything is per lang, null counting as ``und``. Null texts are empty.
Repeated rows count each time; doc_id is only used to pick the sample and may be
null. Ties in score and count go by the phrase's UTF-8 bytes. Texts longer than
a block are counted in blocks that carry their last two words over. An empty
table has no phrases. Further columns are not read.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.llm.common import whole_text
from broadsheet.plans.bitfilter import bit_filter, hits, maybe_in, packed
from broadsheet.plans.skew import first_per_group, salted_join
from broadsheet.plans.storage import stored

LEAST = 10  # occurrences of a frequent phrase
COVERED = 50  # percent of its occurrences from which a longer phrase replaces one
FIRST = 2000  # phrases given for each lang
SAMPLE = 0.25  # part of the documents that proposes
LOWERED = 2  # occurrences in the sample that make a proposal; 2.5 would be LEAST's share
WORD_BITS, PAIR_BITS = 1 << 26, 1 << 26
SLOTS = 64  # parts in which a lang's phrases are cut to the first before they meet
BLOCK = 1 << 20
SEED = 42  # of Spark's xxhash64

_BREAK = b"\n"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 9 + b" ")
_COUNTED = pa.schema([("key", pa.string()), ("n", pa.int64())])  # key: lang, line feed, phrase

# ---- hashes, as Spark's xxhash64 gives them ------------------------------------

# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _hash_long(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of eight bytes."""
    x = (seed + _P5 + np.uint64(8)) ^ (_turned(value * _P2, 31) * _P1)
    x = _turned(x, 27) * _P1 + _P4
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of pairs from the (unsigned) hashes of their words, as signed numbers."""
    return _hash_long(second, _hash_long(first, np.full(len(first), SEED, np.uint64))).view(np.int64)


def _word_key(word: Column) -> Column:
    return F.concat(F.col("lang"), F.lit("\n"), word)


def _pair_key() -> list[Column]:
    parts = (F.split_part("phrase", F.lit(" "), F.lit(i)) for i in (1, 2))
    return [F.xxhash64(_word_key(p)) for p in parts]


# ---- counting in a task -----------------------------------------------------------


def token_blocks(texts: list[str]) -> Iterator[tuple[list[bytes], int]]:
    """Words of the texts in blocks, a break between pieces; the number of words carried over from the block before."""

    def split(data: bytes) -> list[bytes]:
        return [w for w in data.replace(_BREAK, b" \n ").split(b" ") if w]

    held, size = [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass").translate(_TABLE)
        if len(data) <= BLOCK:
            held.append(data)
            size += len(data)
            if size > BLOCK:
                yield split(_BREAK.join(held)), 0
                held, size = [], 0
            continue
        carried: list[bytes] = []
        at = 0
        while at < len(data):
            end = data.find(b" ", at + BLOCK)
            end = len(data) if end < 0 else end
            tokens = carried + split(data[at:end])
            yield tokens, len(carried)
            carried, at = tokens[-2:], end
    if held:
        yield split(_BREAK.join(held)), 0


class Proposed:
    """Which words and pairs are proposed, by filter; all are where there is none."""

    def __init__(self, words: np.ndarray | None, pairs: np.ndarray | None):
        self.words, self.pairs = words, pairs

    def has(self, name: str, hashes: np.ndarray) -> np.ndarray:
        bits = getattr(self, name)
        return np.ones(len(hashes), bool) if bits is None else hits(bits, hashes.view(np.int64))


def _rows(lang: str, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    keys = pc.binary_join_element_wise(pa.scalar(lang.encode(), pa.binary()), phrases, b"\n")
    return pa.RecordBatch.from_arrays([keys.cast(pa.string()), pa.array(n)], schema=_COUNTED)


def counted_block(
    lang: str, tokens: list[bytes], carried: int, now: Proposed, before: Proposed | None, longest: int
) -> Iterator[pa.RecordBatch]:
    """Counts of a block's phrases that are on the border of ``now`` and not of ``before``.

    With ``before``, pairs with a word that is new since then count as proposed.
    """
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    ids, vocabulary = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    names = vocabulary.to_pylist()
    real = np.array([w != _BREAK for w in names], bool)
    start = lang.encode() + b"\n"
    hashes = np.array([xxhash.xxh64_intdigest(start + w, SEED) for w in names], np.uint64)
    if before is None:
        n = np.bincount(ids[carried:], minlength=len(names))
        seen = np.flatnonzero(real & (n > 0))
        yield _rows(lang, pa.array([b""]), np.array([n[seen].sum()]))
        yield _rows(lang, vocabulary.take(pa.array(seen)), n[seen])
    good = real & now.has("words", hashes)
    old = np.zeros(len(names), bool) if before is None else real & before.has("words", hashes)
    at = np.flatnonzero(good[ids[:-1]] & good[ids[1:]])  # where a pair starts
    if not len(at):
        return
    left, right = ids[at], ids[at + 1]
    known = old[left] & old[right]

    def pairs_of(codes: np.ndarray) -> pa.Array:
        first, second = (vocabulary.take(pa.array(c)) for c in (codes // len(names), codes % len(names)))
        return pc.binary_join_element_wise(first, second, b" ")

    here = np.flatnonzero(~known & (at + 1 >= carried))
    code, n = np.unique(left[here] * len(names) + right[here], return_counts=True)
    yield _rows(lang, pairs_of(code), n)
    if longest < 3:
        return
    pair_hash = pair_hashes(hashes[left], hashes[right])
    good2, old2 = now.has("pairs", pair_hash), known
    if before is not None:
        good2 |= ~known  # with a new word it is counted only now, so it may be frequent
        old2 = known & before.has("pairs", pair_hash)
    follows = np.flatnonzero(
        (np.diff(at) == 1) & good2[:-1] & good2[1:] & ~(old2[:-1] & old2[1:]) & (at[:-1] + 2 >= carried)
    )
    head, of = np.unique(left[follows] * len(names) + right[follows], return_inverse=True)
    code3, n3 = np.unique(of * len(names) + right[follows + 1], return_counts=True)
    last = vocabulary.take(pa.array(code3 % len(names)))
    yield _rows(lang, pc.binary_join_element_wise(pairs_of(head).take(pa.array(code3 // len(names))), last, b" "), n3)


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    """The texts of each lang, a block's worth of rows at a time."""
    step = max(1, batch.num_rows * BLOCK // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        texts: dict[str, list[str]] = {}
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            texts.setdefault(lang, []).append(text)
        yield from texts.items()


def counts(
    docs: DataFrame, now: Callable[[], Proposed], before: Callable[[], Proposed] | None, least: int, longest: int = 3
) -> DataFrame:
    """lang, words, phrase, n of phrases with ``n >= least`` in ``docs`` (lang, text); words 0: all words of a lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        proposed, earlier = now(), before and before()
        for batch in batches:
            for lang, texts in _by_lang(batch):
                for tokens, carried in token_blocks(texts):
                    if tokens:
                        yield from counted_block(lang, tokens, carried, proposed, earlier, longest)

    found = docs.select("lang", "text").mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    kept = found.where((F.col("n") >= least) | F.col("key").endswith("\n"))
    phrase = F.substring_index("key", "\n", -1)
    lang = F.left(F.col("key"), F.length("key") - F.length(phrase) - 1)
    named = kept.select(lang.alias("lang"), phrase.alias("phrase"), "n")
    words = F.when(F.col("phrase") == "", 0).otherwise(F.regexp_count("phrase", F.lit(" ")) + 1)
    return named.select("lang", words.alias("words"), "phrase", "n")


# ---- passes ---------------------------------------------------------------------------


class _Proposals:
    """Proposed words and pairs as filters, and what goes to the tasks."""

    def __init__(self, words: DataFrame, pairs: DataFrame):
        self.words, self.pairs = words, pairs
        sent = words.sparkSession.sparkContext.broadcast((packed(words, WORD_BITS), packed(pairs, PAIR_BITS)))
        self.load = lambda: Proposed(*sent.value)

    def failures(self, frequent: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Frequent words and pairs that were not proposed."""
        words = maybe_in(frequent.where("words = 1"), [_word_key(F.col("phrase"))], self.words, "_in", WORD_BITS)
        pairs = maybe_in(frequent.where("words = 2"), _pair_key(), self.pairs, "_in", PAIR_BITS)
        return tuple(stored(f.where("NOT _in").drop("_in"), "failures") for f in (words, pairs))

    def with_more(self, words: DataFrame, pairs: DataFrame) -> "_Proposals":
        both = []
        for old, new in ((self.words, _word_filter(words)), (self.pairs, _pair_filter(pairs))):
            both.append(stored(old.unionByName(new).groupBy("_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits")), "filter"))
        return _Proposals(*both)


def _word_filter(words: DataFrame) -> DataFrame:
    return bit_filter(words, [_word_key(F.col("phrase"))], WORD_BITS)


def _pair_filter(pairs: DataFrame) -> DataFrame:
    return bit_filter(pairs, _pair_key(), PAIR_BITS)


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, sample: float = SAMPLE, lowered: int = LOWERED
) -> DataFrame:
    """Exact counts (lang, words, phrase, n) of all phrases with ``n >= least``; words 0: all words of a lang."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text().alias("text"), "doc_id")
    picked = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(10_000)) < F.lit(int(sample * 10_000)))
    guess = stored(counts(picked, lambda: Proposed(None, None), None, lowered, longest=2).where("words > 0"), "proposals")
    proposed = _Proposals(_word_filter(guess.where("words = 1")), _pair_filter(guess.where("words = 2")))
    found = stored(counts(texts, proposed.load, None, least), "frequent")
    words, pairs = proposed.failures(found)
    if words.isEmpty() and pairs.isEmpty():
        return found
    more = proposed.with_more(words, pairs)
    return found.unionByName(stored(counts(texts, more.load, proposed.load, least), "frequent"))


def collocations(
    docs: DataFrame, least: int = LEAST, first: int = FIRST, sample: float = SAMPLE, lowered: int = LOWERED
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of each lang."""
    frequent = frequent_phrases(docs, least, sample, lowered)
    candidates = frequent.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    # each cut asks for the counts of its two parts; a word may be part of very many phrases
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    sides = cut.withColumn(
        "side",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("at"), F.expr("substring_index(phrase, ' ', k)").alias("part")),
                F.struct(F.lit(1).alias("at"), F.expr("substring_index(phrase, ' ', k - words)").alias("part")),
            )
        ),
    ).select("lang", "phrase", "words", "a", "k", "side.at", "side.part")
    sides = stored(sides, "sides")
    asked = sides.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("_asked"))
    parts = frequent.where("words IN (1, 2)").select("lang", F.col("phrase").alias("part"), F.col("n").alias("_f"))
    met = salted_join(sides, parts, ["lang", "part"], asked, "_asked", ["phrase", "k", "at"])
    scored = (
        met.groupBy("lang", "phrase", "words", "a", "k")
        .agg(F.max(F.when(F.col("at") == 0, F.col("_f"))).alias("l"), F.max(F.when(F.col("at") == 1, F.col("_f"))).alias("r"))
        .withColumn("score", F.expr(
            "(cast(1000000 AS decimal(7,0)) * cast(a AS decimal(15,0)) * cast(a AS decimal(15,0)))"
            " div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"
        ))
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    )
    inner = candidates.where("words = 3").select(
        "lang", "a", F.explode(F.array(F.expr("substring_index(phrase, ' ', 2)"), F.expr("substring_index(phrase, ' ', -2)"))).alias("phrase")
    )
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    left = (
        scored.join(longer, ["lang", "phrase"], "left")
        .where(F.col("_longer").isNull() | (100 * F.col("_longer") < COVERED * F.col("a")))
        .select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score", F.pmod(F.xxhash64("phrase"), F.lit(SLOTS)).alias("_slot"))
    )
    order = [(F.col("score"), "desc"), (F.col("a"), "desc"), (F.col("phrase"), "asc")]
    heads = first_per_group(left, ["lang", "_slot"], order, first, "_place").drop("_slot", "_place")
    ranked = first_per_group(heads, ["lang"], order, first)
    sizes = frequent.where("words = 0").select("lang", "n")
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
