"""Near-duplicates by MinHash with an inverted join on signature coordinates.

Documents with the same set of shingles are one class from the start. A class
has a signature of 40 coordinates, each the least hash of its shingles under one
of 40 hash functions, and is posted under its (coordinate, value) pairs. Two
sets of similarity s agree in a coordinate with chance s; of pairs at 0.8 all
but 6 in a billion agree in 16 or more (``MATCHES``), and only pairs with so
many are held against each other.

Prefix: values that only one class has match nothing and are skipped. The
others are put in order of how many classes have them, rarest first, and only
the first (40 - 16 + 1) places of a signature, counting the skipped ones, are
posted: two signatures with 16 collisions share a posted value whatever the
order. So values that very many documents have, from passages that all carry,
are mostly not posted at all.

Merging: the members of a posting list are matched by the collisions of their
whole signatures, and of the matches a forest is kept that spans them. What
hangs together so is a block; every pair with enough collisions lies in one.
Full sets are then dealt by block, once, and compared in the tasks, which again
give a spanning forest of the links, not all of them. A list or block that is
too large for a task first meets its hub, the member whose values collide most.
Members that match it hang together already and need not meet each other; the
others meet all, dealt over a grid of tasks. (The cost of that rest grows with
its number times the group's: copies of one text that are all just below the
threshold to each other. Rows shuffled grow with that product by ``CELL_BYTES``.)

Shingles are compared by 64-bit hashes, sets by 128-bit digests. Documents
without words have empty sets and are linked with nothing, with each other
neither. A null doc_id counts as the largest. Repeated rows repeat in the
result. An empty table gives an empty result; further columns are not read.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from broadsheet.llm.common import LAST_ID, map_rows, whole_text
from broadsheet.llm.components import components
from broadsheet.llm.simhash import spanning
from broadsheet.plans.bitfilter import BITS, bit_filter, hits, maybe_in, packed, without_misses
from broadsheet.plans.skew import salted_join
from broadsheet.plans.storage import stored

SHINGLE = 4
PERCENT = 80
COORDINATES = 40
MATCHES = 16
CELL_BYTES = 8 << 20  # of a list or block that one task compares
_BLOCK = 4 << 20
_ROWS = 4096  # shingles hashed at once


def _numbers(name: str, n: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{name}{i}") | 1 for i in range(n)], np.uint64)


_TURN, _SPREAD, _MARK = (_numbers(name, COORDINATES) for name in ("turn", "spread", "mark"))
_STEP, _LAST = _numbers("step", 2)


# ---- sets and signatures -------------------------------------------------------


def _word_hashes(data: bytes) -> np.ndarray:
    """64 bits of each word, from blocks of a long text."""
    known: dict[bytes, int] = {}
    parts, at = [], 0
    while at < len(data):
        end = data.find(b" ", at + _BLOCK) if len(data) - at > _BLOCK else -1
        end = len(data) if end < 0 else end
        words = data[at:end].split()
        for w in set(words) - known.keys():
            known[w] = xxhash.xxh64_intdigest(w)
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        if len(known) > 1_000_000:
            known.clear()
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles, sorted; of the whole sequence where it has fewer words."""
    words = _word_hashes((text or "").encode("utf-8", "surrogatepass").lower())  # lowers A-Z only
    if not len(words):
        return words
    size = min(shingle, len(words))
    last = len(words) - size + 1
    joined = np.full(last, size, np.uint64)
    for k in range(size):
        joined = (joined ^ words[k : k + last]) * _STEP
        joined ^= joined >> np.uint64(29)
    return np.unique(joined * _LAST)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The posted values: per coordinate its least hash, marked with the coordinate."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), _ROWS):
        mixed = (shingles[at : at + _ROWS, None] ^ _TURN) * _SPREAD
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, mixed.min(0))
    return ((least ^ _MARK) * _LAST).view(np.int64)


def set_digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signed_documents(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, _set (digest), _values (the signature) and _bytes (one of each value) of every row."""

    def row(doc_id, text) -> Iterator[tuple]:
        shingles = shingle_set(text, shingle)
        values = signature(shingles) if len(shingles) else np.zeros(0, np.int64)
        yield doc_id, len(shingles), set_digest(shingles), values.tolist(), (values >> 32).astype(np.uint8).tobytes()

    schema = "doc_id long, n_shingles long, _set binary, _values array<long>, _bytes binary"
    return map_rows(docs.select("doc_id", whole_text().alias("text")), schema, row)


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """The classes in ``wanted`` (by _set) with _data, their hashes as bytes; other texts are ruled out where they are read."""
    sent = docs.sparkSession.sparkContext.broadcast(packed(bit_filter(wanted, ["_set"])))

    def row(text) -> Iterator[tuple]:
        shingles = shingle_set(text, shingle)
        digest = set_digest(shingles)
        if hits(sent.value, np.array([xxhash.xxh64_intdigest(digest, 42)], np.uint64).view(np.int64))[0]:
            yield digest, shingles.tobytes()

    found = map_rows(docs.select(whole_text().alias("text")), "_set binary, _data binary", row)
    return found.dropDuplicates(["_set"]).join(wanted, "_set")


# ---- postings ---------------------------------------------------------------------


def postings(classes: DataFrame) -> DataFrame:
    """_group (the value), _id, _data (a byte of each coordinate), _n and _weight: classes under the values of their prefixes."""
    every = classes.select("_id", F.explode("_values").alias("_value"))
    counted = every.groupBy("_value").agg(F.count(F.lit(1)).alias("_classes"))
    shared = stored(counted.where("_classes > 1"), "shared")
    may_match = without_misses(every, ["_value"], bit_filter(shared, ["_value"], BITS), BITS)
    met = salted_join(may_match, shared, "_value", shared, "_classes", ["_id"])
    of_class = Window.partitionBy("_id")  # has one row a coordinate at most
    placed = met.select(
        "*",
        F.count(F.lit(1)).over(of_class).alias("_shared"),
        F.sum("_classes").over(of_class).alias("_weight"),
        F.row_number().over(of_class.orderBy("_classes", "_value")).alias("_place"),
    )
    # the values that are not shared have the first places
    prefix = placed.where(F.col("_place") <= F.col("_shared") - MATCHES + 1).select("_value", "_id", "_weight")
    signed = classes.select("_id", "_bytes", F.col("n_shingles").alias("_n"))
    signed = prefix.join(signed, "_id")  # a class has one posting a coordinate at most
    return stored(signed.select(F.col("_value").alias("_group"), "_id", F.col("_bytes").alias("_data"), "_n", "_weight"), "postings")


# ---- matching in tasks ---------------------------------------------------------------

Compare = Callable[[list[bytes], np.ndarray, list[bytes], np.ndarray], np.ndarray]


def _sizes_alike(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(n[:, None], m) >= PERCENT * np.maximum(n[:, None], m)


def collisions_suffice(a: list[bytes], n: np.ndarray, b: list[bytes], m: np.ndarray) -> np.ndarray:
    """Which signatures of ``a`` and ``b`` (rows and columns) may belong to similar sets."""
    x, y = (np.frombuffer(b"".join(d), np.uint8).reshape(-1, COORDINATES) for d in (a, b))
    count = np.zeros((len(x), len(y)), np.uint8)
    for k in range(COORDINATES):
        count += x[:, k, None] == y[:, k]
    return (count >= MATCHES) & _sizes_alike(n, m)


def sets_alike(a: list[bytes], n: np.ndarray, b: list[bytes], m: np.ndarray) -> np.ndarray:
    """Which sets of ``a`` and ``b`` are as similar as asked, by exact counts of common shingles."""
    left, right = (np.frombuffer(b"".join(d), np.uint64) for d in (a, b))
    common = np.intersect1d(left, right)  # others are in no pair
    both = np.zeros((len(a), len(b)), np.float32)
    own, other = (np.repeat(np.arange(len(d)), size) for d, size in ((a, n), (b, m)))
    for at in range(0, len(common), _COLUMNS):
        part = common[at : at + _COLUMNS]
        tables = []
        for values, rows, size in ((left, own, len(a)), (right, other, len(b))):
            place = np.minimum(np.searchsorted(part, values), len(part) - 1)
            here = part[place] == values
            table = np.zeros((size, len(part)), np.float32)
            table[rows[here], place[here]] = 1
            tables.append(table)
        both += tables[0] @ tables[1].T
    both = both.astype(np.int64)  # sums of ones, exact up to 2^24 shingles
    return 100 * both >= PERCENT * (n[:, None] + m - both)


def _edges(ids: np.ndarray, n: np.ndarray, data: list[bytes], kinds: np.ndarray, compare: Compare) -> tuple[np.ndarray, np.ndarray]:
    """A forest that spans the matches of a cell: its outsiders (kind 0 or 2) with all (kind 1 or 2).

    Matches go into the forest block by block, as there may be the square of the cell's members.
    Rows that hang together already are compared only with columns that do not hang with them.
    """
    rows, columns = np.flatnonzero(kinds != 1), np.flatnonzero(kinds != 0)
    nodes, node = np.unique(ids, return_inverse=True)
    label = np.arange(len(nodes))
    top = node  # of each member, the node that it hangs on
    for at in range(0, len(rows), _ROWS_AT_ONCE):
        some, left = rows[at : at + _ROWS_AT_ONCE], columns
        if at and (top[some] == top[some[0]]).all():
            left = columns[top[columns] != top[some[0]]]
        near = [data[k] for k in some]
        for start in range(0, len(left), _COLUMNS_AT_ONCE):
            far = left[start : start + _COLUMNS_AT_ONCE]
            i, j = np.nonzero(compare(near, n[some], [data[k] for k in far], n[far]))
            a, b = top[some[i]], top[far[j]]
            apart = a != b
            if apart.any():
                label = spanning(len(nodes), a[apart], b[apart])[label]
                top = label[node]
    hung = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[hung], nodes[label[hung]]


_ROWS_AT_ONCE = 256
_COLUMNS_AT_ONCE = 2048
_COLUMNS = 4096


def _in_cells(compare: Compare) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Works on rows _group, _row, _column, _id, _n, _kind, _data, sorted by cell: whole cells at a time."""

    def work(table: pa.Table) -> pa.RecordBatch:
        keys = np.stack([table.column(k).to_numpy() for k in range(3)])
        starts = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(0))))
        ids, n, kinds = (table.column(k).to_numpy() for k in (3, 4, 5))
        data = table.column(6).to_pylist()
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
            if stop - start > 1:
                x, y = _edges(ids[start:stop], n[start:stop], data[start:stop], kinds[start:stop], compare)
                a.append(x)
                b.append(y)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (a, b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(h.nbytes for h in held) < _FLUSH_BYTES:
                continue
            table = pa.Table.from_batches(held)
            last = [table.column(k)[table.num_rows - 1].as_py() for k in range(3)]
            same = np.logical_and.reduce([table.column(k).to_numpy() == v for k, v in enumerate(last)])
            cut = int(np.argmax(same))  # the last cell may go on
            if cut:
                yield work(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield work(pa.Table.from_batches(held))

    return run


_FLUSH_BYTES = 4 << 20


def matches(members: DataFrame, compare: Compare) -> DataFrame:
    """Edges (a, b) that span all matches within the groups of ``members`` (_group, _id, _n, _weight, _data)."""
    size = F.octet_length("_data") + 64
    groups = members.groupBy("_group").agg(F.count(F.lit(1)).alias("_rows"), F.sum(size).alias("_size"), F.max(F.struct("_weight", "_id")).alias("_hub"))
    weights = stored(groups.where(F.col("_size") > CELL_BYTES).select("_group", "_rows", "_size", F.col("_hub._id").alias("_top")), "groups")

    def in_one_cell(rows: DataFrame) -> DataFrame:
        return rows.select("_group", F.lit(0).alias("_row"), F.lit(0).alias("_column"), "_id", "_n", F.lit(2).alias("_kind"), "_data")

    if weights.isEmpty():
        cells, edges = in_one_cell(members), None
    else:
        # members of small groups stay where they are until they go to their cell
        tested = maybe_in(members, ["_group"], bit_filter(weights, ["_group"]), "_maybe")
        met = salted_join(tested.where("_maybe").drop("_maybe"), weights.drop("_rows"), "_group", weights, "_rows", ["_id"], how="left")
        cells = in_one_cell(tested.where("NOT _maybe")).unionByName(in_one_cell(met.where("_top IS NULL")))
        large = stored(met.where("_top IS NOT NULL"), "large")
        hubs = large.where("_id = _top").select("_group", F.col("_n").alias("_m"), F.col("_data").alias("_hub"))
        beside = salted_join(large, hubs, "_group", weights, "_rows", ["_id"])

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for group, i, top, n, data, m, hub in zip(*[c.to_pylist() for c in batch.columns]):
                    out.append((group, i, top, bool(compare([data], np.array([n]), [hub], np.array([m]))[0, 0])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["_group", "_id", "_top", "_near"])

        met = beside.select("_group", "_id", "_top", "_n", "_data", "_m", "_hub").mapInArrow(near, "_group long, _id long, _top long, _near boolean")
        met = stored(met, "met")
        edges = met.where("_near AND _id <> _top").select(F.col("_id").alias("a"), F.col("_top").alias("b"))
        outside = met.where("NOT _near").select("_group", "_id", F.lit(True).alias("_out"))
        marked = stored(large.join(outside, ["_group", "_id"], "left").withColumn("_out", F.coalesce("_out", F.lit(False))), "marked")
        sizes = marked.where("_out").groupBy("_group").agg(F.ceil(F.sum(size) / CELL_BYTES).cast("int").alias("_down"))
        grid = stored(weights.join(sizes, "_group").withColumn("_across", F.ceil(F.col("_size") / CELL_BYTES).cast("int")), "grid")
        dealt = salted_join(marked, grid.select("_group", "_down", "_across"), "_group", grid, "_rows", ["_id"])
        spot = F.xxhash64("_id")
        rows = dealt.where("_out").withColumn("_row", F.pmod(spot, F.col("_down")).cast("int")).withColumn(
            "_column", F.explode(F.sequence(F.lit(0), F.col("_across") - 1))
        )
        columns = dealt.withColumn("_column", F.pmod(spot, F.col("_across")).cast("int")).withColumn(
            "_row", F.explode(F.sequence(F.lit(0), F.col("_down") - 1))
        )
        names = ["_group", "_row", "_column", "_id", "_n"]
        cells = cells.unionByName(rows.select(*names, F.lit(0).alias("_kind"), "_data")).unionByName(
            columns.select(*names, F.lit(1).alias("_kind"), "_data")
        )
    key = ["_group", "_row", "_column"]
    found = cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(_in_cells(compare), "a long, b long")
    return stored(found if edges is None else found.unionByName(edges), "edges")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept of every row."""
    own = stored(signed_documents(docs, shingle).withColumn("_doc", F.coalesce("doc_id", F.lit(LAST_ID))), "signed")
    grouped = own.where("n_shingles > 0").groupBy("_set").agg(
        F.min("_doc").alias("_first"), F.count(F.lit(1)).alias("_rows"),
        F.first("n_shingles").alias("n_shingles"), F.first("_values").alias("_values"), F.first("_bytes").alias("_bytes"),
    )
    classes = stored(grouped.withColumn("_id", F.monotonically_increasing_id()), "classes")
    posted = postings(classes)
    blocks = components(matches(posted, collisions_suffice)).select(F.col("node").alias("_id"), F.col("component").alias("_group"))
    weight = F.col("_rows").alias("_weight")
    placed = stored(blocks.join(classes.select("_id", "_set", F.col("n_shingles").alias("_n"), weight), "_id"), "blocks")
    weighed = placed.join(posted.select("_id", "_weight").distinct().withColumnRenamed("_weight", "_collides"), "_id", "left")
    wanted = stored(weighed.select("_set", "_group", "_id", "_n", F.coalesce("_collides", "_weight").alias("_weight")), "wanted")
    members = stored(full_sets(docs, wanted, shingle).drop("_set"), "members")
    named = components(matches(members, sets_alike)).select(F.col("node").alias("_id"), F.col("component").alias("_in"))
    found = stored(
        classes.select("_id", "_set", "_first", "_rows").join(named, "_id", "left").withColumn("_in", F.coalesce("_in", "_id")),
        "placed",
    )
    firsts = stored(found.groupBy("_in").agg(F.min("_first").alias("_least"), F.count(F.lit(1)).alias("_classes")), "firsts")
    found = stored(
        salted_join(found, firsts.select("_in", "_least"), "_in", firsts, "_classes", ["_id"]).select("_set", "_least", "_rows"),
        "found",
    )
    joined = salted_join(own.drop("_values", "_bytes"), found.select("_set", "_least"), "_set", found, "_rows", ["_doc"], how="left")
    least = F.coalesce("_least", "_doc")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(least != LAST_ID, least).alias("component_id"),
        (least == F.col("_doc")).alias("kept"),
    )
