"""Near-duplicates by SimHash, with candidates from a Golay code.

A fingerprint has three segments of 22, 21 and 21 bits. Two that differ in at
most two bits agree in one segment at least, and differ in at most two bits in
any other. The second is found through the perfect Golay code of 23 bits, which
corrects three errors: a word at distance 3 from its codeword is also given the
five codewords at distance 4, any other word its own codeword only; then two
words that differ in at most two bits always share a codeword. So a fingerprint
has up to 18 keys, (exact segment, codeword of the next segment), and each link
shows in one of them.

Equal fingerprints are one row from the start. Keys are shuffled, not pairs;
links are verified within a key, and of a task's batch of whole keys only a
forest that spans them is kept, so n fingerprints give at most n - 1 rows. Where a key has many
fingerprints, links are found through the words one bit away from each instead
of by comparing pairs.

Null and empty texts have fingerprint zero and are linked like any other; a
null doc_id counts as the largest. Repeated rows repeat in the result.
"""

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.llm.common import LAST_ID, map_rows, whole_text, without_losers
from broadsheet.llm.components import components
from broadsheet.plans.skew import salted_join
from broadsheet.plans.storage import stored

BITS = 2
SHINGLE = 3
SEED = 42
PAIRWISE = 64  # fingerprints of a key that are compared in pairs
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift and width

# Fixed value: the generator polynomial of the Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
_GENERATOR = 0b101011100011


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: each is set if it is set in over half of the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # lowers A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - shingle + 1)
    stops = ends[min(shingle, len(words)) - 1 :][:last]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, last, _BLOCK):
        spans = zip(starts[at : min(last, at + _BLOCK)].tolist(), stops[at : at + _BLOCK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > last).tobytes(), "big")


_BLOCK = 8192


def _number() -> Column:
    """doc_id; null counts as the largest."""
    return F.coalesce(F.col("doc_id"), F.lit(LAST_ID))


def _text_digest() -> Column:
    return F.unhex(F.md5(whole_text()))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, ``_t`` (128 bits of the text) and the fingerprint, as a signed 64-bit integer."""

    def row(doc_id, key, text):
        value = fingerprint(text, shingle)
        yield doc_id, key, value - (value >> 63 << 64)

    return map_rows(
        docs.select("doc_id", _text_digest().alias("_t"), whole_text().alias("text")), "doc_id long, _t binary, fingerprint long", row
    )


# ---- Golay code ------------------------------------------------------------


def _syndrome(words: np.ndarray) -> np.ndarray:
    """The remainder of 23-bit words by the generator: 11 bits."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, _GENERATOR << (bit - 11), 0)
    return rest


@cache
def golay_tables() -> np.ndarray:
    """Per syndrome six error patterns: the nearest codeword's, then those at distance 4.

    Syndromes of fewer than three errors have their only pattern six times.
    """
    table = np.zeros((2048, 6), np.int64)
    for weight in range(1, 4):
        errors = np.array([sum(1 << b for b in c) for c in combinations(range(23), weight)], np.int64)
        table[_syndrome(errors)] = errors[:, None]
    far = np.array([sum(1 << b for b in c) for c in combinations(range(23), 4)], np.int64)
    syndromes = _syndrome(far)
    order = np.argsort(syndromes, kind="stable")
    table[np.unique(syndromes), 1:] = far[order].reshape(-1, 5)
    return table


def codewords(words: np.ndarray) -> np.ndarray:
    """Six codeword indices (12 bits) of each 23-bit word; the same one again where it has fewer."""
    return (words[:, None] ^ golay_tables()[_syndrome(words)]) >> 11


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``prints`` (unsigned) and keys, without repeats."""
    owners, keys = [], []
    parts = [(prints >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1) for shift, width in SEGMENTS]
    for i, exact in enumerate(parts):
        index = codewords(parts[(i + 1) % 3])
        key = (((i << 22) | exact)[:, None] << 12) | index
        alone = index[:, 1] == index[:, 0]
        owners += [np.arange(len(prints)), np.repeat(np.flatnonzero(~alone), 5)]
        keys += [key[:, 0], key[~alone, 1:].ravel()]
    return np.concatenate(owners), np.concatenate(keys)


# ---- links -----------------------------------------------------------------


def _linked(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of equal key (rows sorted by key), enough to span all there are."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.concatenate((first, [len(keys)])))
    left, right = [], []
    many = np.repeat(size, size) > PAIRWISE
    for step in range(1, min(PAIRWISE, int(size.max(initial=0)))):
        a = np.flatnonzero((keys[step:] == keys[:-step]) & ~many[step:])
        if not len(a):
            break
        a = a[np.bitwise_count(prints[a] ^ prints[a + step]) <= BITS]
        left.append(a)
        right.append(a + step)
    one_bit = np.concatenate(([0], np.uint64(1) << np.arange(64, dtype=np.uint64))).astype(np.uint64)
    for start, n in zip(first[size > PAIRWISE], size[size > PAIRWISE]):
        # rows that differ in two bits at most share a word one bit away from both
        near = (prints[start : start + n, None] ^ one_bit).ravel()
        order = np.argsort(near, kind="stable")
        same = near[order][1:] == near[order][:-1]
        left.append(start + order[:-1][same] // 65)
        right.append(start + order[1:][same] // 65)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def spanning(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest row that the links lead to."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by key, from batches; only whole keys are worked on."""
    held_keys, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def work(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        left, right = _linked(keys, prints)
        nodes, node = np.unique(prints, return_inverse=True)  # a fingerprint under several keys is one node
        label = spanning(len(nodes), node[left], node[right])
        hung = np.flatnonzero(label != np.arange(len(nodes)))
        columns = [nodes[hung].view(np.int64), nodes[label[hung]].view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b"])

    for batch in batches:
        held_keys = np.concatenate((held_keys, batch.column(0).to_numpy(zero_copy_only=False)))
        held = np.concatenate((held, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
        if len(held_keys):
            cut = int(np.searchsorted(held_keys, held_keys[-1]))  # the last key may go on
            yield work(held_keys[:cut], held[:cut])
            held_keys, held = held_keys[cut:], held[cut:]
    yield work(held_keys, held)


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that span all pairs of distinct fingerprints within ``BITS`` bits."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            owner, key = keys_of(values)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(values[owner].view(np.int64))], names=["key", "fingerprint"])

    keyed = prints.select("fingerprint").mapInArrow(spread, "key long, fingerprint long")
    return keyed.repartition("key").sortWithinPartitions("key", "fingerprint").mapInArrow(_forest, "a long, b long")


def _classed(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, _t, _id, fingerprint and component_id (null ids as the largest) of every row."""
    own = stored(
        fingerprints(docs, shingle).withColumn("_id", _number()), "fingerprints"
    )
    distinct = stored(
        own.groupBy("fingerprint").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows")), "prints"
    )
    linked = components(links(distinct))
    named = stored(
        distinct.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
            "component", F.coalesce("component", "fingerprint")
        ),
        "classes",
    )
    firsts = stored(
        named.groupBy("component").agg(F.min("_first").alias("component_id"), F.count(F.lit(1)).alias("_prints")), "firsts"
    )
    classes = stored(
        salted_join(named, firsts.select("component", "component_id"), "component", firsts, "_prints", ["fingerprint"]),
        "classes",
    )
    return salted_join(own, classes.select("fingerprint", "component_id"), "fingerprint", classes, "_rows", ["_id"])


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    return _classed(docs, shingle).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("component_id") != LAST_ID, F.col("component_id")).alias("component_id"),
    )


def representatives(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, that of the smallest doc_id, with all its columns.

    Of several rows of that id the one of smallest text digest stays, once. Only
    texts of rows that go are moved, and few others.
    """
    classed = stored(_classed(docs, shingle).select("_t", "_id", "component_id"), "classed")
    groups = classed.groupBy("component_id").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_id", "_t")).alias("_first"))
    groups = stored(groups.where("_n > 1"), "groups")
    joined = salted_join(classed, groups.drop("_n"), "component_id", groups, "_n", ["_id", "_t"])
    keys = joined.groupBy(F.col("_id").alias("__k0"), F.col("_t").alias("__k1")).agg(
        F.bool_or(F.col("_first") == F.struct("_id", "_t")).alias("__stays"), F.count(F.lit(1)).alias("__rows")
    )
    verdict = stored(keys.where("NOT __stays OR __rows > 1").drop("__rows"), "verdict")
    return without_losers(docs, [_number(), _text_digest()], verdict)
