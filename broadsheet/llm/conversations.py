"""The prefix trie of conversations by collapsing whole sequences.

Turns become narrow rows first: a digest of role and text, and the bytes of the
text. A prefix of turns is named by its depth and 128 bits of running sums over
digests of (place, turn), so names come from sums within a conversation and not
from arrays of turns; equal sequences have equal names.

Identical conversations then collapse into one weighted sequence with a list of
its conversations (its end list). Sequences that are proper prefixes of others
are found by an anti join with the names of proper prefixes; what is left are
the leaves. Prefixes of the weighted sequences are summed to nodes. A node is
counted once, in the sequence of its smallest member: there its saving starts a
running sum from the end of the sequence to the root, so a subtree is summed
without visiting it.

Groups may be of any size: turns of one conversation are numbered and summed
over many tasks, hot nodes (the root is in every sequence) are salted, and end
lists are put together from pieces of 4,096 ids, hashed one after the other.

Turns are ordered by turn (null first), equal ones by the digest of role and
text. Null roles and texts are empty ones; rows without conv_id belong to no
conversation and are left out. Repeated rows are turns of their own. Further
columns are not read. An empty table has no nodes.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.plans.skew import ranked, running_sums, salted_join
from broadsheet.plans.storage import stored

MOST_HEAD = 9  # heads have fewer turns than this
FAMILY = 5  # conversations that take their head from the same one
PIECE_IDS = 4096  # ids of a piece of an end list
_LIMBS = ["_s0", "_s1", "_s2", "_s3"]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), _digest and _bytes of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    narrow = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.unhex(F.md5(marked)).alias("_digest"), F.octet_length(text).cast("long").alias("_bytes")
    )
    order = [(F.col("turn").isNotNull(), "asc"), (F.col("turn"), "asc"), (F.col("_digest"), "asc")]
    numbered = ranked(narrow, order, "place", ["conv_id"])
    return numbered.select("conv_id", F.col("place").cast("long").alias("place"), "_digest", "_bytes")


def head_length(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST_HEAD).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, depth, _digest, _bytes) of rebuilt conversations, and their lengths (conv_id, _length)."""
    lengths = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_turns")), "lengths")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    headed = lengths.select("conv_id", "_turns", head_length(F.col("conv_id")).alias("_head"), first.alias("_first"))
    given = lengths.select(F.col("conv_id").alias("_first"), F.col("_turns").alias("_given"))
    headed = stored(
        headed.join(given, "_first", "left").withColumn("_taken", F.least("_head", F.coalesce("_given", F.lit(0)))), "heads"
    )
    # a conversation gives at most eight turns, to the few of its family
    heads = headed.select("conv_id", "_first", "_taken").join(
        turns.where(F.col("place") < MOST_HEAD).withColumnRenamed("conv_id", "_first"), "_first"
    )
    heads = heads.where("place <= _taken").select("conv_id", F.col("place").alias("depth"), "_digest", "_bytes")
    own = salted_join(turns, headed.select("conv_id", "_head", "_taken"), "conv_id", headed, "_turns", ["place"])
    own = own.where("place > _head").select(
        "conv_id", (F.col("_taken") + F.col("place") - F.col("_head")).alias("depth"), "_digest", "_bytes"
    )
    whole = F.col("_taken") + F.greatest(F.lit(0), F.col("_turns") - F.col("_head"))
    return heads.unionByName(own), headed.select("conv_id", whole.alias("_length"))


def _limbs(text: Column) -> list[Column]:
    """128 bits of a digest as four numbers of 32 bits, which may be summed."""
    digest = F.md5(text)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(c) for i, c in enumerate(_LIMBS)]


def _name(depth: Column, limbs: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[c.cast("string") for c in limbs])))


def _root() -> Column:
    return _name(F.lit(0), [F.lit(0)] * 4)


def prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, node, parent (names of the prefix and of the one before) and _bytes of rebuilt turns."""
    own = _limbs(F.concat_ws(":", F.col("depth").cast("string"), F.hex("_digest")))
    placed = rows.select("conv_id", "depth", "_bytes", *own)
    # the row's own numbers are kept beside the sums: sums less own name the parent
    kept = placed.select("*", *[F.col(c).alias(f"{c}_own") for c in _LIMBS])
    summed = running_sums(kept, ["conv_id"], [(F.col("depth"), "asc")], _LIMBS)
    before = [F.col(c) - F.col(f"{c}_own") for c in _LIMBS]
    return summed.select(
        "conv_id",
        "depth",
        _name(F.col("depth"), [F.col(c) for c in _LIMBS]).alias("node"),
        _name(F.col("depth") - 1, before).alias("parent"),
        "_bytes",
    )


def _end_digests(ends: DataFrame, weights: DataFrame) -> DataFrame:
    """node and ends_sha256 for nodes where conversations end; ``ends`` has conv_id and node."""
    alone = weights.where("_weight = 1").select("node", F.sha2(F.col("conv_id").cast("string"), 256).alias("ends_sha256"))
    many = weights.where("_weight > 1")
    listed = salted_join(ends, many.select("node"), "node", many, "_weight", ["conv_id"])
    placed = ranked(listed.select("node", "conv_id"), [(F.col("conv_id"), "asc")], "_nth", ["node"])
    ids = F.array_sort(F.collect_list("conv_id"))
    pieces = placed.groupBy("node", F.floor((F.col("_nth") - 1) / PIECE_IDS).alias("_piece")).agg(
        F.array_join(F.transform(ids, lambda i: i.cast("string")), ",").alias("_ids")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != last:
                    if last is not None:
                        done.append((last, state.hexdigest()))
                    last, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["node", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    # the pieces of a node in order: SHA-256 goes through a list from its start
    sorted_pieces = pieces.repartition("node").sortWithinPartitions("node", "_piece").select("node", "_ids")
    return alone.unionByName(sorted_pieces.mapInArrow(digest, "node binary, ends_sha256 string"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = stored(turn_rows(conversations), "turns")
    rows, lengths = rebuilt(turns)
    named = stored(prefixes(rows), "prefixes")

    # whole sequences with their weight and smallest conversation
    last = named.join(lengths.where("_length > 0"), "conv_id").where("depth = _length").select("conv_id", "node", "_length")
    ends = stored(last.unionByName(lengths.where("_length = 0").select("conv_id", _root().alias("node"), "_length")), "ends")
    sequences = stored(
        ends.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("_weight"), F.first("_length").alias("_length")
        ),
        "sequences",
    )
    # their prefixes, the root first; of equal conversations only the smallest goes on
    sized = sequences.select("conv_id", "_weight", "_length")
    own = salted_join(named, sized, "conv_id", sized, "_length", ["depth"])
    top = sized.select("conv_id", F.lit(0).cast("long").alias("depth"), _root().alias("node"),
                       F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("_bytes"), "_weight", "_length")
    paths = stored(own.unionByName(top), "paths")

    proper = paths.where("depth < _length").select("node").distinct()
    leaves = sequences.join(proper, "node", "left_anti").select("conv_id", F.lit(1).alias("_leaf"), "_length")
    nodes = stored(
        paths.groupBy("node").agg(
            F.sum("_weight").alias("n_convs"), F.min("conv_id").alias("_smallest"), F.count(F.lit(1)).alias("_paths")
        ),
        "nodes",
    )
    # each node in the sequence of its smallest member, each sequence with its end
    met = salted_join(paths, nodes.select("node", "n_convs", "_smallest"), "node", nodes, "_paths", ["conv_id"])
    first = F.col("_smallest") == F.col("conv_id")
    owned = met.select(
        "conv_id", "depth", "node", "parent", first.alias("_first"), "n_convs",
        F.when(first, (F.col("n_convs") - 1) * F.col("_bytes")).otherwise(0).alias("_saved"),
    )
    owned = stored(owned, "owned")
    saved = running_sums(owned.select("conv_id", "depth", "node", "_saved"), ["conv_id"], [(F.col("depth"), "desc")], ["_saved"])
    ended = salted_join(paths.select("conv_id", "depth", "node"), leaves.select("conv_id", "_leaf"), "conv_id",
                        sized, "_length", ["depth"])
    parts = saved.select("node", F.col("_saved").alias("saved_tokens"), F.lit(0).alias("n_leaves")).unionByName(
        ended.select("node", F.lit(0).cast("long").alias("saved_tokens"), F.col("_leaf").alias("n_leaves"))
    )
    summed = parts.groupBy("node").agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").cast("long").alias("n_leaves"))
    once = owned.where("_first").select("node", "parent", F.col("conv_id"), "depth", "n_convs")
    children = stored(once.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children")), "children")
    over = once.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    hung = salted_join(once, over, "parent", children.select(F.col("node").alias("parent"), "n_children"), "n_children",
                       ["node"], how="left")
    return (
        hung.join(summed, "node")
        .join(children, "node", "left")
        .join(_end_digests(ends, sequences), "node", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
