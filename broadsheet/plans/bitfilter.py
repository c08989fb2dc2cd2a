"""Membership of keys in a table, tested where rows are read.

A filter holds one bit per hash value, 2^26 of them by default, as bitmaps of
32,768 bits made by Spark's own aggregate. It never takes more than ``bits / 8``
bytes, so it may be sent to all executors whatever the table's size. It answers
"maybe" or "no": a key of the table is never ruled out, another one sometimes is
not. With more keys it rules out less, so what follows has to decide exactly.
"""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.plans.storage import stored

BITS = 1 << 26
BITMAP_BITS = 1 << 15  # of one bitmap of Spark's aggregate


def _place(keys: Sequence[str | Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def bit_filter(table: DataFrame, keys: Sequence[str | Column], bits: int = BITS) -> DataFrame:
    """The filter of the ``keys`` in ``table``: ``_bucket`` and ``_bits``, at most ``bits / 32768`` rows."""
    place = _place(keys, bits)
    found = (
        table.select(F.floor(place / BITMAP_BITS).alias("_bucket"), F.pmod(place, F.lit(BITMAP_BITS)).alias("_at"))
        .groupBy("_bucket")
        .agg(F.bitmap_construct_agg("_at").alias("_bits"))
    )
    return stored(found, "filter")


def maybe_in(frame: DataFrame, keys: Sequence[str | Column], bit_table: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """``frame`` with the column ``name``: false only for keys that are not in the filter's table.

    The filter is sent to the tasks that read the frame; no row moves.
    """
    at = F.pmod(F.col("__place"), F.lit(BITMAP_BITS))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("getbit", byte, (at % 8).cast("int")) == 1
    placed = frame.withColumn("__place", _place(keys, bits)).withColumn("_bucket", F.floor(F.col("__place") / BITMAP_BITS))
    tested = placed.join(F.broadcast(bit_table), "_bucket", "left").withColumn(name, F.coalesce(bit, F.lit(False)))
    return tested.select(*frame.columns, name)


def without_misses(frame: DataFrame, keys: Sequence[str | Column], bit_table: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of ``frame`` that may have a key in the filter's table."""
    return maybe_in(frame, keys, bit_table, "__maybe", bits).where("__maybe").drop("__maybe")


def packed(bit_table: DataFrame, bits: int = BITS) -> np.ndarray:
    """The filter as ``bits / 8`` bytes, for tasks in Python."""
    whole = np.zeros(bits // 8, np.uint8)
    for row in bit_table.toLocalIterator():
        at = row["_bucket"] * (BITMAP_BITS // 8)
        whole[at : at + BITMAP_BITS // 8] = np.frombuffer(row["_bits"], np.uint8)
    return whole


def hits(whole: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which signed 64-bit hashes (as Spark's xxhash64 gives) may be in the packed filter."""
    place = np.mod(hashes, np.int64(len(whole) * 8))
    return (whole[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
