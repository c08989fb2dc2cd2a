"""Anchors: places that repeated passages share, and the pieces around them.

Every window of a sequence (50 words, 200 bytes) has an anchor: of the short
grams in it the one of least hash, the leftmost of these. Equal windows have
equal anchors at equal offsets, so windows need to be compared only within the
pieces of text around equal anchors. Anchors are few (one in some tens of
symbols); those whose gram occurs once are dropped before any text is moved.

Texts of which very many rows are exact copies are told apart first, from
their hashes, so that only one row of each has its passages looked at.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.llm.common import LAST_ID, whole_text
from broadsheet.plans.skew import hot_keys
from broadsheet.plans.storage import stored

BLOCK = 1 << 20  # symbols worked on at once
_BASE = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 20) - 1)


@cache
def _powers(base: int) -> np.ndarray:
    """The powers of an odd number, modulo 2**64."""
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(BLOCK, base, np.uint64))))


class Roller:
    """Hashes of any run of a sequence of up to ``BLOCK`` symbols, by sums of powers."""

    def __init__(self, values: np.ndarray):
        self.down = _powers(pow(_BASE, -1, 1 << 64))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values + np.uint64(1)) * _powers(_BASE)[: len(values)], out=self.sums[1:])

    def runs(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stops] - self.sums[starts]) * self.down[starts])

    def grams(self, size: int) -> np.ndarray:
        """The hash of every run of ``size`` symbols."""
        return mixed((self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width``."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def anchors(values: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash, first and last window start of the anchors of a sequence.

    Long sequences are worked on block by block; blocks overlap by a window, so
    that every window lies in one. An anchor found in two blocks comes twice,
    with the windows of each.
    """
    out = []
    step = BLOCK - window
    for at in range(0, max(1, len(values) - window + 1), step):
        part = values[at : at + step + window - 1]
        if len(part) < window:
            break
        hashes = Roller(part).grams(gram)
        marked = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        place = (_sliding_least(marked, window - gram + 1) & _LOW).astype(np.int64)
        turn = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.concatenate((turn[1:], [len(place)])) - 1
        out.append((place[turn] + at, hashes[place[turn]], turn + at, last + at))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none, none
    return tuple(np.concatenate(c) for c in zip(*out))  # type: ignore[return-value]


def packed_places(place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place and window range in one integer; a window starts at most 255 before its anchor."""
    return (place << 16) | ((place - first) << 8) | (place - last)


def unpacked_places(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    place = packed >> 16
    return place, place - ((packed >> 8) & 255), place - (packed & 255)


def row_key(docs: DataFrame) -> list[Column]:
    """doc_id as ``_d`` (null as the largest), ``_t`` (of the text) and ``_r`` (of the row)."""
    text = whole_text()
    number = F.coalesce(F.col("doc_id"), F.lit(LAST_ID))
    return [number.alias("_d"), F.md5(text).alias("_t"), F.xxhash64(number, text).alias("_r")]


class Copies:
    """Texts of ``least`` symbols or more with so many rows that they would fill a shuffle partition.

    There are fewer of them than shuffle partitions, so their list may be
    broadcast. ``rows`` are the rows left to look at: of a listed text only
    those with its smallest doc_id (marked ``_listed``). ``others`` are the
    rest, without text: doc_id and ``_size``.
    """

    def __init__(self, docs: DataFrame, size: Column, least: int):
        number, digest, row = row_key(docs)
        narrow = stored(docs.select("doc_id", number, digest, size.alias("_size")), "digests")
        classes = stored(
            narrow.where(F.col("_size") >= least)
            .groupBy("_t")
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_d").alias("_least"), F.max("_d").alias("_most"))
            .where("_least < _most"),
            "copies",
        )
        parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        hot = hot_keys(classes, ["_t"], "_n", parts)
        listed = F.broadcast(stored(classes.join(F.broadcast(hot.select("_t")), "_t").select("_t", "_least"), "listed"))
        whole = docs.select("doc_id", whole_text().alias("text"), number, digest, row)
        self.rows = (
            whole.join(listed, "_t", "left")
            .where("_least IS NULL OR _d = _least")
            .select("doc_id", "_d", "_r", "text", F.col("_least").isNotNull().alias("_listed"))
        )
        self.others = narrow.join(listed, "_t").where("_d <> _least").select("doc_id", "_size")


def anchor_rows(texts: DataFrame, sequence, window: int, gram: int) -> DataFrame:
    """_h, _d, _r and packed places of the anchors of all texts; ``sequence`` makes symbols of UTF-8."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for number, row, text in zip(*[c.to_pylist() for c in batch.columns]):
                place, hashes, first, last = anchors(sequence(text.encode("utf-8", "surrogatepass")), window, gram)
                if len(place):
                    held.append((number, row, hashes.view(np.int64), packed_places(place, first, last)))
                    size += len(place)
                if size > 200_000:
                    yield _anchor_batch(held)
                    held, size = [], 0
            if held:
                yield _anchor_batch(held)

    return texts.select("_d", "_r", "text").mapInArrow(find, "_h long, _d long, _r long, _p long")


def _anchor_batch(held: list[tuple]) -> pa.RecordBatch:
    size = [len(h[2]) for h in held]
    columns = [
        np.concatenate([h[2] for h in held]),
        np.repeat(np.array([h[0] for h in held], np.int64), size),
        np.repeat(np.array([h[1] for h in held], np.int64), size),
        np.concatenate([h[3] for h in held]),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["_h", "_d", "_r", "_p"])


def with_places(texts: DataFrame, found: DataFrame) -> DataFrame:
    """The texts that have anchors in ``found``, with their hashes, places and whether they are hot.

    Lists are no longer than the text they belong to.
    """
    listed = found.groupBy("_r").agg(F.collect_set(F.struct("_h", "_p", "_hot")).alias("_found"))
    return texts.join(listed, "_r").select(*texts.columns, "_found")


def key_runs(batches: Iterator[pa.RecordBatch], most: int = 2000) -> Iterator[pa.Table]:
    """Rows sorted by their first column, in tables that hold whole keys."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < most:
            continue
        keys = held.column(0).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held
