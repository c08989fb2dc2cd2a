"""Repeated byte strings by suffix sorting: every ``WINDOW`` bytes that start twice go.

1. Every window of 200 bytes has an anchor of ``GRAM`` bytes (see anchors.py).
   Anchors that occur once are dropped.
2. The pieces around the others go to shards by anchor. There, the suffixes
   from the anchor on are sorted, and so are the reversed parts before it, by
   deep-shallow sorting: multikey quicksort, on characters of eight bytes,
   to a depth of ``SHALLOW`` bytes; groups still equal are ordered by a blind
   trie. Common prefixes of neighbours say, for every window, whether another
   piece has the same bytes on both sides of the anchor.
3. The repeated windows go back to their documents.

An anchor with more than ``HOT`` pieces is not gathered in one task: its
windows are counted by their hash (128 bits), combined before the shuffle.

A null text is empty. Rows that repeat both doc_id and text are one document;
a null doc_id counts as the largest.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.anchors import Copies, anchor_rows, key_runs, unpacked_places, with_places
from broadsheet.llm.common import map_columns, whole_text
from broadsheet.llm.passages import covered
from broadsheet.plans.skew import salted_join
from broadsheet.plans.storage import stored

WINDOW = 200
GRAM = 50
SHALLOW = 64
HOT = 20_000


# ---- deep-shallow sorting --------------------------------------------------


class BlindTrie:
    """Orders distinct strings of one length; inner nodes hold a depth and the bytes that follow it."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: int | list = 0  # a leaf is the number of its string
        for i in range(1, len(strings)):
            self._insert(i)

    def _insert(self, new: int) -> None:
        text = self.strings[new]
        node = self.root
        while isinstance(node, list):  # blindly: bytes between the depths are not looked at
            node = node[1].get(text[node[0]]) if text[node[0]] in node[1] else next(iter(node[1].values()))
        depth = common_prefix(text, self.strings[node])
        above, byte, node = None, None, self.root
        while isinstance(node, list) and node[0] < depth:
            above, byte = node, text[node[0]]
            node = node[1][byte]
        if isinstance(node, list) and node[0] == depth:
            node[1][text[depth]] = new
            return
        leaf = node
        while isinstance(leaf, list):
            leaf = next(iter(leaf[1].values()))
        fresh = [depth, {self.strings[leaf][depth]: node, text[depth]: new}]
        if above is None:
            self.root = fresh
        else:
            above[1][byte] = fresh

    def ordered(self) -> tuple[list[int], list[int]]:
        """The strings' numbers in order, and each one's common prefix with the one before (0 first)."""
        order, prefix = [], []
        todo: list[tuple[int | list, int]] = [(self.root, 0)]
        while todo:
            node, depth = todo.pop()
            if isinstance(node, list):
                below = [node[1][b] for b in sorted(node[1])]
                todo += [(child, node[0]) for child in reversed(below[1:])]
                todo.append((below[0], depth))
            else:
                order.append(node)
                prefix.append(depth)
        return order, prefix


def common_prefix(a: bytes, b: bytes) -> int:
    """Equal leading bytes of two strings of one length."""
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (differ.bit_length() + 7) // 8


def deep_shallow(strings: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of strings (rows of bytes) by group, then content, and common prefixes.

    The second result has, for each place of the order, the number of bytes it
    shares with the place before; -1 where a group begins. ``group`` ascends.
    """
    n, width = strings.shape
    order = np.arange(n)
    prefix = np.full(n, width)  # until a difference is found
    begins = np.ones(n, bool)
    begins[1:] = group[1:] != group[:-1]
    prefix[begins] = -1
    characters = strings.view(">u8")
    for at in range(min(shallow, width) // 8):
        # places whose group still has two members at least
        number = np.cumsum(begins) - 1
        live = np.flatnonzero(np.bincount(number)[number] > 1)
        if not len(live):
            return order, prefix
        char = characters[order[live], at].astype(np.uint64)
        turn = np.lexsort((char, number[live]))
        order[live] = order[live[turn]]
        char = char[turn]
        split = np.flatnonzero((char[1:] != char[:-1]) & ~begins[live[1:]])
        place = live[1:][split]
        zeros = np.frombuffer((char[1:][split] ^ char[:-1][split]).astype(">u8").tobytes(), np.uint8).reshape(-1, 8)
        prefix[place] = 8 * at + (zeros != 0).argmax(1)
        begins[place] = True
    number = np.cumsum(begins) - 1
    size = np.bincount(number)
    starts = np.flatnonzero(begins)
    for start, members in zip(starts[size > 1].tolist(), size[size > 1].tolist()):
        inside = order[start : start + members]
        alike: dict[bytes, list[int]] = {}
        for row in inside.tolist():
            alike.setdefault(strings[row].tobytes(), []).append(row)
        if len(alike) == 1:
            continue
        distinct = list(alike)
        at = start
        for i, shared in zip(*BlindTrie(distinct).ordered()):
            rows = alike[distinct[i]]
            order[at : at + len(rows)] = rows
            if at > start:
                prefix[at] = shared
            prefix[at + 1 : at + len(rows)] = width
            at += len(rows)
    return order, prefix


# ---- repeated windows ------------------------------------------------------


def repeated_in_shard(group: np.ndarray, before: np.ndarray, count: np.ndarray, pieces: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Per piece the least and largest offset of its anchor in a window that another piece has, too.

    ``before`` is the anchor's offset in the piece, ``count`` the number of
    windows of the piece. Where there is none, the least is above the largest.
    """
    n = len(pieces)
    high, low = before, before - count + 1  # offsets of the anchor in the piece's windows
    left_width, right_width = -(-max(1, int(high.max())) // 8) * 8, -(-window // 8) * 8
    left, right = np.zeros((n, left_width), np.uint8), np.zeros((n, right_width), np.uint8)
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.fromiter(map(len, pieces), np.int64, n)
    row = np.repeat(np.arange(n), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) - before[row]
    ahead = place >= 0
    right[row[ahead], place[ahead]] = flat[ahead]
    left[row[~ahead], -1 - place[~ahead]] = flat[~ahead]
    right_order, right_prefix = deep_shallow(right, group)
    left_order, left_prefix = deep_shallow(left, group)
    least, most = np.full(n, window), np.full(n, -1)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for offset in range(int(low.min()), int(high.max()) + 1):
        rows = np.flatnonzero((low <= offset) & (offset <= high))
        if len(rows) < 2:
            continue
        right_class[right_order] = np.cumsum(right_prefix < window - offset)
        left_class[left_order] = np.cumsum(left_prefix < offset)
        both = right_class[rows] * (n + 1) + left_class[rows]
        turn = np.argsort(both, kind="stable")
        same = both[turn][1:] == both[turn][:-1]
        again = np.zeros(len(rows), bool)
        again[turn[1:][same]] = True
        again[turn[:-1][same]] = True
        found = rows[again]
        least[found] = np.minimum(least[found], offset)
        most[found] = offset
    return least, most


def _shard(window: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_runs(batches):
            key, number, row, place, before, count = (table.column(i).to_numpy() for i in range(6))
            pieces = table.column(6).to_pylist()
            # a repeated row has its pieces twice
            order = np.lexsort((place - before, row, key))
            twice = np.zeros(len(order), bool)
            for column in (key, row, place - before):
                twice[1:] |= column[order][1:] != column[order][:-1]
            keep = order[np.concatenate(([True], twice[1:]))]
            once = np.concatenate(([True], key[keep][1:] != key[keep][:-1]))
            group = np.cumsum(once)
            several = np.bincount(group)[group] > 1
            keep, group = keep[several], group[several]
            if not len(keep):
                continue
            least, most = repeated_in_shard(group, before[keep], count[keep], [pieces[i] for i in keep], window)
            hit = least <= most
            at = keep[hit]
            # windows of a piece start less than a window apart, so what they cover is one span
            a, b = place[at] - most[hit], place[at] - least[hit] + window
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(c)) for c in (number[at], row[at], a, b)], names=["_d", "_r", "a", "b"]
                )

    return find


def _pieces(window: int):
    """Rows of (_key, _d, _r, place, offset of the anchor, windows, piece) around the anchors of a text."""

    def rows(_ids, numbers, keys, texts, _listed, found) -> Iterator[tuple]:
        for number, key, text, places in zip(numbers, keys, texts, found):
            data = text.encode("utf-8", "surrogatepass")
            for one in places:
                if not one["_hot"]:
                    place, first, last = (int(x) for x in unpacked_places(np.int64(one["_p"])))
                    yield one["_h"], number, key, place, place - first, last - first + 1, data[first : last + window]

    return rows


def _hot_windows(window: int):
    """Rows of (window hash in two parts, _d, _r, start) for the windows around hot anchors."""

    def rows(_ids, numbers, keys, texts, _listed, found) -> Iterator[tuple]:
        for number, key, text, places in zip(numbers, keys, texts, found):
            data = text.encode("utf-8", "surrogatepass")
            for one in places:
                if one["_hot"]:
                    _, first, last = (int(x) for x in unpacked_places(np.int64(one["_p"])))
                    for start in range(first, last + 1):
                        digest = hashlib.md5(data[start : start + window]).digest()
                        yield (*np.frombuffer(digest, np.int64).tolist(), number, key, start)

    return rows


def _symbols(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).astype(np.uint64)


def repeated_spans(rows: DataFrame, texts: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """_d, _r, a, b: bytes a to b of a row that are covered by repeated windows; spans may overlap.

    ``texts`` are the ``rows`` dealt by ``_r``.
    """
    found = stored(anchor_rows(rows, _symbols, window, gram).select("_h", "_r", "_p"), "anchors")
    shared = stored(
        found.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h", (F.col("_n") > hot).alias("_hot")),
        "shared",
    )
    placed = with_places(texts, found.join(shared, "_h"))
    pieces = map_columns(
        placed, "_key long, _d long, _r long, place long, before long, n long, piece binary", _pieces(window), most=1 << 20
    )
    spans = pieces.repartition("_key").sortWithinPartitions("_key").mapInArrow(_shard(window), "_d long, _r long, a long, b long")
    if shared.where("_hot").isEmpty():
        return spans
    # in one plan with the pieces, so that the texts dealt by _r are used again
    windows = map_columns(
        placed.where(F.exists("_found", lambda x: x["_hot"])),
        "w1 long, w2 long, _d long, _r long, a long", _hot_windows(window), most=1 << 18,
    ).dropDuplicates(["w1", "w2", "_r", "a"])
    counts = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = salted_join(windows, counts.select("w1", "w2"), ["w1", "w2"], counts, "_n", ["_r", "a"])
    return spans.unionByName(again.select("_d", "_r", "a", (F.col("a") + window).alias("b")))


def _kept(window: int, keep_text: bool):
    def rows(doc_ids, numbers, _rows, texts, listed, spans) -> Iterator[tuple]:
        for doc_id, number, text, copies, own in zip(doc_ids, numbers, texts, listed, spans):
            data = text.encode("utf-8", "surrogatepass")
            inside = [(0, len(data))] if copies else [(s["a"], s["b"]) for s in own or [] if s["_d"] == number]
            gone = covered(inside, len(data))
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            yield doc_id, len(data), int(gone.sum()), runs, kept if keep_text else hashlib.sha256(kept).hexdigest()

    return rows


def without_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, keep_text: bool = True
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes kept (kept_bytes), or their SHA-256 (kept_sha256)."""
    copies = Copies(docs, F.octet_length(whole_text()).cast("long"), window)
    texts = copies.rows.repartition("_r")
    spans = (
        repeated_spans(copies.rows, texts, window, gram, hot)
        .groupBy("_r")
        .agg(F.collect_set(F.struct("_d", "a", "b")).alias("_spans"))
    )
    last = "kept_bytes binary" if keep_text else "kept_sha256 string"
    looked_at = map_columns(
        texts.join(spans, "_r", "left").select("doc_id", "_d", "_r", "text", "_listed", "_spans"),
        f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}", _kept(window, keep_text), most=1 << 20,
    )
    empty = F.lit(b"").alias("kept_bytes") if keep_text else F.sha2(F.lit(""), 256).alias("kept_sha256")
    others = copies.others.select(
        "doc_id", F.col("_size").alias("n_bytes"), F.col("_size").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), empty
    )
    return looked_at.unionByName(others)
