"""Prefix trie of conversations by truncation peeling.

A task starts at the depth of its longest conversation with an empty frontier and peels: conversations that end at this depth join the
frontier, entries of one prefix become one node, the node is given out, its last turn is stripped, and what is left is grouped anew one
level higher. A node is complete when it is discovered. Nodes that several tasks hold are merged by key; each conversation then carries the
nodes whose smallest member it is, and a second peeling adds up subtrees, which needs every node once.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.llm.common import mixed, runs
from funnelspark.session import write_stage

#: Conversations that share a donor of first turns, and the number of different lengths taken from it.
GROUP, HEADS = 100, 6
#: Turns that are peeled together in a task; a longer conversation is peeled alone.
TURNS = 1 << 18
#: Ids are joined to pieces of about so many characters before those of one node meet in a task.
PIECE = 1 << 16

KEY = ["depth", "k1", "k2"]
_TURNS = "array<struct<src:int,pos:int,h1:bigint,h2:bigint,size:int>>"


def rebuilt(conversations: DataFrame, conv_id: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """conv and turns (hashes and code points, in order) of every conversation: a few first turns of the group's first conversation, then its own.

    Turns are ordered by number, null first, equal numbers by the hash of role and text. Rows without a conv_id belong to none and are left out.
    """
    said = lambda seed: F.xxhash64(F.lit(seed), F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit("")))
    rows = conversations.select(conv_id.cast("long").alias("conv"), turn.alias("turn"), said(1).alias("h1"), said(2).alias("h2"), F.length(F.coalesce(text.cast("string"), F.lit(""))).alias("size"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "h1", "h2")
    first = F.col("conv") % GROUP == 0
    rows = rows.where("conv is not null").withColumn("pos", F.row_number().over(order)).withColumns({
        "taken": (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int"), "donor": F.col("conv") - F.col("conv") % GROUP,
    })
    rows = write_stage(rows.drop("turn"), "turns")
    turn_of = lambda src: F.struct(F.lit(src).alias("src"), "pos", "h1", "h2", "size")
    own = rows.where(first | (F.col("pos") > F.col("taken"))).select("conv", turn_of(1).alias("turn"))
    heads = rows.where(first & (F.col("pos") < HEADS)).select(F.col("conv").alias("donor"), turn_of(0).alias("turn"))
    every = rows.where("pos = 1").select("conv", "donor", "taken")
    # At most GROUP conversations take from one donor.
    lent = every.where(~first & (F.col("taken") > 0)).join(heads, "donor").where(F.col("turn.pos") <= F.col("taken")).select("conv", "turn")
    bare = every.select("conv", F.lit(None).cast(own.schema["turn"].dataType).alias("turn"))
    made = own.union(lent).union(bare).groupBy("conv").agg(F.sort_array(F.collect_list("turn")).cast(_TURNS).alias("turns"))
    return write_stage(made, "conversations")


class Conversations:
    """Some conversations with the keys of all their prefixes: exclusive-or of hashes of (place, turn), 128 bits."""

    def __init__(self, ids: np.ndarray, turns: pa.ListArray):
        self.ids, self.lengths = ids, turns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = turns.flatten()
        self.starts = np.cumsum(self.lengths) - self.lengths
        place = np.arange(len(flat)) - np.repeat(self.starts, self.lengths)
        self.size = flat.field("size").to_numpy(zero_copy_only=False).astype(np.int64)
        self.keys = [self._prefixes(flat.field(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), place, seed) for name, seed in (("h1", 0x9E3779B97F4A7C15), ("h2", 0xC2B2AE3D27D4EB4F))]

    def _prefixes(self, said: np.ndarray, place: np.ndarray, seed: int) -> np.ndarray:
        salted = mixed(said + (place + 1).astype(np.uint64) * np.uint64(seed))
        all_ = np.append(np.uint64(0), np.bitwise_xor.accumulate(salted))
        return all_[1:] ^ np.repeat(all_[self.starts], self.lengths)

    def key(self, which: int, conv: np.ndarray, depth: int) -> np.ndarray:
        return self.keys[which][self.starts[conv] + depth - 1] if depth else np.zeros(len(conv), dtype=np.uint64)


def peel(some: Conversations, ended: list[np.ndarray], own: list[tuple[np.ndarray, np.ndarray]] | None = None) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """Nodes from the deepest level to the root: depth, the member with the smallest id, and the sums of the values.

    A conversation enters the frontier with its values of ``ended`` where it ends. ``own`` are values of nodes, per turn and (second) at the root, held by
    the node's smallest member: they are added when the node is given out.
    """
    order = np.argsort(-some.lengths, kind="stable")
    deepest = int(some.lengths.max(initial=0))
    bounds = np.searchsorted(-some.lengths[order], -np.arange(deepest + 1), side="left")
    member, values = np.zeros(0, dtype=np.int64), [v[:0] for v in ended]
    for depth in range(deepest, -1, -1):
        new = order[bounds[depth]:bounds[depth - 1] if depth else len(order)]
        member, values = np.concatenate([member, new]), [np.concatenate([v, e[new]]) for v, e in zip(values, ended)]
        k1, k2 = some.key(0, member, depth), some.key(1, member, depth)
        # The smallest id comes first and survives.
        place = np.lexsort((some.ids[member], k2, k1))
        k1, k2 = k1[place], k2[place]
        cut = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))
        member, values = member[place][cut], [np.add.reduceat(v[place], cut) for v in values]
        if own is not None:
            values = [v + (turns[some.starts[member] + depth - 1] if depth else root[member]) for v, (turns, root) in zip(values, own)]
        yield depth, member, values


def _batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``most`` turns, or one longer conversation."""
    for batch in batches:
        for low, high in runs((batch.column("turns").value_lengths().to_numpy(zero_copy_only=False) + 1).tolist(), most):
            yield batch.slice(low, high - low)


def _signed(key: np.ndarray) -> pa.Array:
    return pa.array(key.view(np.int64))


def _discover(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Nodes of a task with the number of members there, their smallest id, the last turn's size and the parent's key."""
    for batch in _batches(batches, most):
        some = Conversations(batch.column("conv").to_numpy(zero_copy_only=False), batch.column("turns"))
        for depth, member, (n,) in peel(some, [np.ones(len(some.ids), dtype=np.int64)]):
            up = max(depth - 1, 0)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(member), depth, dtype=np.int64)), _signed(some.key(0, member, depth)), _signed(some.key(1, member, depth)), pa.array(n), pa.array(some.ids[member]),
                pa.array(some.size[some.starts[member] + depth - 1] if depth else np.zeros(len(member), dtype=np.int64)), _signed(some.key(0, member, up)), _signed(some.key(1, member, up)),
            ], names=[*KEY, "n_convs", "conv_id", "size", "p1", "p2"])


def _subtrees(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Nodes of a task with what their subtrees there add to saved_tokens and n_leaves."""
    for batch in _batches(batches, most):
        some = Conversations(batch.column("conv").to_numpy(zero_copy_only=False), batch.column("turns"))
        nodes, held = batch.column("nodes").flatten(), batch.column("nodes").value_lengths().to_numpy(zero_copy_only=False)
        conv, depth = np.repeat(np.arange(len(some.ids)), held), nodes.field("depth").to_numpy(zero_copy_only=False)
        own = []
        for name in ("saved", "leaf"):
            value, turns, root = nodes.field(name).to_numpy(zero_copy_only=False), np.zeros(len(some.size), dtype=np.int64), np.zeros(len(some.ids), dtype=np.int64)
            turns[(some.starts[conv] + depth - 1)[depth > 0]] = value[depth > 0]
            root[conv[depth == 0]] = value[depth == 0]
            own.append((turns, root))
        nothing = np.zeros(len(some.ids), dtype=np.int64)
        for level, member, (saved, leaves) in peel(some, [nothing, nothing], own):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(member), level, dtype=np.int64)), _signed(some.key(0, member, level)), _signed(some.key(1, member, level)), pa.array(saved), pa.array(leaves)], names=[*KEY, "saved", "leaves"])


def _ends(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The node each conversation ends at."""
    for batch in _batches(batches, most):
        some = Conversations(batch.column("conv").to_numpy(zero_copy_only=False), batch.column("turns"))
        last, none = some.starts + some.lengths - 1, some.lengths == 0
        keys = [np.where(none, np.uint64(0), np.append(k, np.uint64(0))[np.where(none, -1, last)]) for k in some.keys]
        yield pa.RecordBatch.from_arrays([pa.array(some.lengths), _signed(keys[0]), _signed(keys[1]), pa.array(some.ids)], names=[*KEY, "conv"])


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted ids of a node joined by commas, in pieces of bounded length, each with its first id."""
    node, ids, length = None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in node], pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], names=[*KEY, "first", "ids"])

    for batch in batches:
        done = []
        for *key, conv in zip(*[batch.column(c).to_pylist() for c in (*KEY, "conv")], strict=True):
            if node is not None and (key != node or length > most):
                done.append(piece())
                ids, length = [], 0
            node, length = key, length + len(str(conv)) + 1
            ids.append(conv)
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if node is not None:
        yield piece()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each node, in the order they come; only one state is held."""
    node, state = None, None
    for batch in batches:
        keys, hashes = [], []
        for *key, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")], strict=True):
            if key == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                keys.append(node)
                hashes.append(state.hexdigest())
            node, state = key, hashlib.sha256(ids.encode())
        if keys:
            yield pa.RecordBatch.from_arrays([*[pa.array([k[j] for k in keys], pa.int64()) for j in range(3)], pa.array(hashes)], names=[*KEY, "ends"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in node], pa.array([state.hexdigest()])], names=[*KEY, "ends"])


def prefix_trie(conversations: DataFrame, conv_id: Column, turn: Column, role: Column, text: Column, most: int = TURNS, characters: int = PIECE) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without a conv_id are left out; null roles and texts are empty; the group of an id is id - id % 100 as SQL has it (that of -5 is 0); a null turn comes first, turns of one number are ordered by hash, so repeated rows are
    turns of their own. A conversation without any turn left is a member of the root alone. No conversations, no rows. Other columns, of whatever names, are not read.
    The keys of one conversation (32 bytes a turn) are held by one task; conversations that share a node may be any number.
    """
    number = "depth long, k1 long, k2 long"
    convs = rebuilt(conversations, conv_id, turn, role, text)
    nodes = convs.mapInArrow(functools.partial(_discover, most=most), f"{number}, n_convs long, conv_id long, size long, p1 long, p2 long").groupBy(*KEY).agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("size").alias("size"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = write_stage(nodes, "nodes")

    none = lambda kind: F.lit(None).cast(kind)
    children = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), *[none("long").alias(c) for c in ("n_convs", "conv_id", "size", "p1", "p2")], F.lit(1).cast("long").alias("child"))
    nodes = nodes.withColumn("child", F.lit(0).cast("long")).union(children).groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in ("n_convs", "conv_id", "size", "p1", "p2")], F.sum("child").alias("n_children"))
    nodes = write_stage(nodes, "nodes")

    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"))
    placed = nodes.join(above, ["depth", "p1", "p2"], "left")
    held = nodes.select("conv_id", F.struct("depth", ((F.col("n_convs") - 1) * F.col("size")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaf")).alias("node"))
    held = held.groupBy(F.col("conv_id").alias("conv")).agg(F.collect_list("node").alias("nodes"))
    sums = convs.join(held, "conv").mapInArrow(functools.partial(_subtrees, most=most), f"{number}, saved long, leaves long")

    ends = write_stage(convs.mapInArrow(functools.partial(_ends, most=most), f"{number}, conv long"), "ends")
    pieces = ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv").mapInArrow(functools.partial(_pieces, most=characters), f"{number}, first long, ids string")
    hashes = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_hashes, f"{number}, ends string")

    parts = [
        placed.select(*KEY, "conv_id", "parent", "n_convs", "n_children", none("long").alias("saved"), none("long").alias("leaves"), none("string").alias("ends")),
        sums.select(*KEY, *[none("long").alias(c) for c in ("conv_id", "parent", "n_convs", "n_children")], "saved", "leaves", none("string").alias("ends")),
        hashes.select(*KEY, *[none("long").alias(c) for c in ("conv_id", "parent", "n_convs", "n_children", "saved", "leaves")], "ends"),
    ]
    one = parts[0].union(parts[1]).union(parts[2]).groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in ("conv_id", "parent", "n_convs", "n_children", "ends")], F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    return one.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
