"""Prefix trie of conversations, where nodes are the distinct beginnings of whole turns.

A turn is named by the first 16 bytes of the SHA-256 of its role and text, read as a big-endian number, so a conversation is a byte string of
16 bytes a turn and the trie of turns is the radix tree of these strings cut at multiples of 16. Strings are sorted in ranges (a hot first
turn spans many ranges, as does a hot conversation: ids break ties). Each block of a range, of bounded bytes, becomes an adaptive radix
tree (`radix`). Nodes off the ways to the first and the last string of a block lie in that block alone and are final. Nodes on these two ways, the
spine, may go on in other blocks: their parts are stitched by one pass over the spines in order, which holds one way, and which is the only single
task (rows: blocks x turns of two conversations). The ids that end at a spine node are hashed in order from packed pieces, as SHA-256 needs.

What one task holds of a conversation is 20 bytes a turn, never its texts.

Defined results: null roles and texts are empty; turns of one number are in order of role, then text, null numbers first; repeated rows are turns
of their own. Rows without conv_id belong to no conversation and are left out. Empty conversations are members of the root. Without any
conversation there is no root and no row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import radix
from llm.tables import materialise

WIDTH = 16
LENGTH = 4
BLOCK_BYTES = 1 << 20
IDS_IN_PIECE = 10_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

BLOCK_SCHEMA = pa.schema([
    ("kind", pa.string()), ("block", pa.int64()), ("side", pa.int32()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("parent_side", pa.int32()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("turn", pa.binary()), ("length", pa.int64()),
    ("ids", pa.binary()),
])
BLOCK_DDL = (
    "kind string, block long, side int, depth long, conv_id long, parent_conv_id long, parent_side int, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, turn binary, length long, ids binary"
)
FIRST, LAST = 0, 1


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one conversation in sorted turns as (conv_id, part, run, ids, lengths), two strings of bytes."""
    part, run = TaskContext.get().partitionId(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        convs = batch.column("conv_id").to_numpy()
        cuts = [0, *(np.flatnonzero(convs[1:] != convs[:-1]) + 1), len(convs)]
        ids = b"".join(batch.column("id").to_pylist())
        lengths = batch.column("length").to_numpy().astype("<i4").tobytes()
        spans = list(zip(cuts, cuts[1:]))
        yield pa.RecordBatch.from_arrays([
            pa.array([int(convs[a]) for a, _ in spans], pa.int64()), pa.array([part] * len(spans), pa.int32()),
            pa.array(range(run, run + len(spans)), pa.int64()),
            pa.array([ids[WIDTH * a : WIDTH * b] for a, b in spans], pa.binary()),
            pa.array([lengths[LENGTH * a : LENGTH * b] for a, b in spans], pa.binary()),
        ], names=["conv_id", "part", "run", "ids", "lengths"])
        run += len(spans)


def conversations_of(rows: DataFrame) -> DataFrame:
    """(conv_id, ids, lengths): every conversation as bytes, from rows of (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH))
    turns = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        name.alias("id"), F.char_length(text).alias("length"),
    )
    order = ["conv_id", "turn", "role", "text"]
    runs = turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        packed, "conv_id long, part int, run long, ids binary, lengths binary"
    )
    merged = runs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "run", "ids", "lengths"))).alias("runs"))
    nothing = F.lit(b"")
    whole = lambda field: F.aggregate("runs", nothing, lambda made, run: F.concat(made, run[field]))
    return materialise(merged.select("conv_id", whole("ids").alias("ids"), whole("lengths").alias("lengths")), "conversations")


def spliced(conversations: DataFrame, donor: Column, turns: Column) -> DataFrame:
    """Each conversation's first turns replaced by as many of the donor's (all if it has fewer, none if it does not exist)."""
    taking = conversations.withColumn("donor", donor).withColumn("h", turns)
    lent = conversations.select(F.col("conv_id").alias("donor"), F.col("ids").alias("head"), F.col("lengths").alias("head_lengths"))
    givers = lent.join(taking.select("donor").distinct(), "donor", "left_semi")
    most = F.lit((1 << 31) - 1)

    def mixed(head: str, own: str, width: int) -> Column:
        size = (F.col("h") * width).cast("int")
        return F.concat(F.coalesce(F.substring(head, F.lit(1), size), F.lit(b"")), F.substring(own, size + 1, most))

    return taking.join(givers, "donor", "left").select(
        "conv_id", mixed("head", "ids", WIDTH).alias("ids"), mixed("head_lengths", "lengths", LENGTH).alias("lengths")
    )


def block_rows(keys: list[bytes], lengths: list[bytes], convs: list[int], block: int) -> Iterator[dict]:
    """Rows of one block of sorted keys: final nodes, parts of spine nodes, and pieces of the ids that end at spine nodes."""
    tree = radix.Tree()
    for i, key in enumerate(keys):
        tree.insert(key, i)
    order = list(tree.preorder())
    first, last = keys[0], keys[-1]
    for node, parent, above, end in order:
        # members, smallest id, children, leaves and saving below the node's last turn, then the same without spine nodes
        node.notes = [len(node.values), min((convs[i] for i in node.values), default=None), 0, 0, 0, 0, 0, 0]
    on = {}
    for node, parent, above, end in order:
        was = on[parent] if parent else (True, True)
        key = keys[node.sample]
        on[node] = tuple(w and k[:end] == key[:end] for w, k in zip(was, (first, last)))

    def up(node, parent, above, end):
        """The children, leaves and saving that a node shows to the place above its edge; as a part of the spine, too."""
        n, low, children, leaves, saved, *closed = node.notes
        spine = any(on[node])
        for depth in range(end // WIDTH, above // WIDTH, -1):
            length = int.from_bytes(lengths[node.sample][LENGTH * (depth - 1) : LENGTH * depth], "little") if depth else 0
            children, leaves, saved = 1, leaves if children else 1, saved + (n - 1) * length
            closed = [0, 0, 0]
        return n, low, children, leaves, saved, *(closed if spine else (children, leaves, saved))

    for node, parent, above, end in reversed(order):
        if parent:
            n, low, *sums = up(node, parent, above, end)
            notes = parent.notes
            notes[0] += n
            notes[1] = low if notes[1] is None else min(notes[1], low)
            for i, value in enumerate(sums, 2):
                notes[i] += value

    owners = {}
    for node, parent, above, end in order:
        n, low, children, leaves, saved, *closed = node.notes
        sides = [side for side in (FIRST, LAST) if on[node][side]]
        made = []
        key, sizes = keys[node.sample], lengths[node.sample]
        for depth in range(end // WIDTH, above // WIDTH, -1):
            length = int.from_bytes(sizes[LENGTH * (depth - 1) : LENGTH * depth], "little") if depth else 0
            ends = [convs[i] for i in node.values] if depth * WIDTH == end else []
            if sides:
                row = dict(kind="spine", n_children=closed[0], n_leaves=closed[1], saved_tokens=closed[2], turn=key[WIDTH * (depth - 1) : WIDTH * depth] if depth else b"", length=length)
                for at in range(0, len(ends), IDS_IN_PIECE):
                    ids = ",".join(map(str, ends[at : at + IDS_IN_PIECE])).encode()
                    yield dict(kind="ends", block=block, side=sides[0], depth=depth, conv_id=ends[at], ids=ids)
                row |= dict(side=sides[0])
                children, leaves, saved, closed = 1, 0, 0, [0, 0, 0]
            else:
                saved += (n - 1) * length
                leaves = leaves if children else 1
                row = dict(kind="node", n_children=children, n_leaves=leaves, saved_tokens=saved)
                row |= dict(ends_sha256=hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else NO_ENDS)
                children = 1
            made.append(row | dict(block=block, depth=depth, conv_id=low, n_convs=n))
        over = owners[parent] if parent else None
        for row in reversed(made):
            if row["kind"] == "node":
                row["parent_conv_id"], row["parent_side"] = (None, over["side"]) if over["kind"] == "spine" else (over["conv_id"], None)
            yield row
            over = row
        owners[node] = over


def trie_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted (ids, conv_id, lengths) as rows."""
    part, number = TaskContext.get().partitionId(), 0
    keys: list[bytes] = []
    lengths: list[bytes] = []
    convs: list[int] = []
    held = 0

    def flushed():
        rows = block_rows(keys, lengths, convs, (part << 32) + number)
        while some := list(islice(rows, 10_000)):
            yield pa.RecordBatch.from_pylist(some, schema=BLOCK_SCHEMA)

    for batch in batches:
        for key, length, conv in zip(batch.column("ids").to_pylist(), batch.column("lengths").to_pylist(), batch.column("conv_id").to_pylist()):
            keys.append(key)
            lengths.append(length)
            convs.append(conv)
            held += len(key) + WIDTH
            if held >= BLOCK_BYTES:
                yield from flushed()
                keys, lengths, convs, held = [], [], [], 0
                number += 1
    if keys:
        yield from flushed()


STITCHED = pa.schema([
    ("kind", pa.string()), ("uid", pa.int64()), ("parent_uid", pa.int64()), ("block", pa.int64()), ("side", pa.int32()), ("depth", pa.int64()),
    ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
])
STITCHED_DDL = (
    "kind string, uid long, parent_uid long, block long, side int, depth long, conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long"
)


def stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spine parts in the order of blocks as whole nodes, and which node (`uid`) each part belongs to.

    Holds the way to the newest string; a node is whole when the way leaves it.
    """
    way: list[dict] = []
    made, uid, block, side = [], 0, None, None

    def left(depth: int) -> None:
        while len(way) > depth:
            node = way.pop()
            node["saved_tokens"] += (node["n_convs"] - 1) * node.pop("length")
            node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
            if way:
                way[-1]["n_leaves"] += node["n_leaves"]
                way[-1]["saved_tokens"] += node["saved_tokens"]
            node.pop("turn")
            made.append(node | {"kind": "node"})

    along = True
    for batch in batches:
        for row in batch.to_pylist():
            depth = row["depth"]
            if row["block"] != block:
                block, side, along = row["block"], FIRST, True
            if row["side"] != side:
                side, along = row["side"], False
                left(depth)
            if along and depth < len(way) and way[depth]["turn"] == row["turn"]:
                node = way[depth]
                node["conv_id"] = min(node["conv_id"], row["conv_id"])
                for field in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                    node[field] += row[field]
            else:
                along = False
                left(depth)
                node = {f: row[f] for f in ("turn", "length", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")}
                node |= {"uid": uid, "parent_uid": way[-1]["uid"] if way else None}
                if way:
                    way[-1]["n_children"] += 1
                way.append(node)
                uid += 1
            made.append({"kind": "part", "uid": node["uid"], "block": block, "side": row["side"], "depth": depth})
        yield pa.RecordBatch.from_pylist(made, schema=STITCHED)
        made.clear()
    left(0)
    yield pa.RecordBatch.from_pylist(made, schema=STITCHED)


def ends_hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined pieces of each node, in order; holds one piece."""
    last, running, uids, digests = None, None, [], []
    for batch in batches:
        for uid, ids in zip(batch.column("uid").to_pylist(), batch.column("ids").to_pylist()):
            if running is not None and uid == last:
                running.update(b",")
            else:
                if running is not None:
                    uids.append(last)
                    digests.append(running.hexdigest())
                last, running = uid, hashlib.sha256()
            running.update(ids)
    if running is not None:
        uids.append(last)
        digests.append(running.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(digests, pa.string())], names=["uid", "digest"])


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node, from (conv_id, ids, lengths)."""
    stored = materialise(conversations.select("conv_id", "ids", "lengths"), "trie-keys")
    ranged = stored.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    rows = materialise(ranged.mapInArrow(trie_rows, BLOCK_DDL), "trie-blocks")
    parts = rows.filter("kind = 'spine'").select(
        "block", "side", "depth", "turn", "length", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"
    )
    whole = materialise(parts.repartition(1).sortWithinPartitions("block", "side", "depth").mapInArrow(stitched, STITCHED_DDL), "trie-spine")
    spine = whole.filter("kind = 'node'")
    low = spine.select(F.col("uid").alias("parent_uid"), F.col("conv_id").alias("parent_conv_id"))
    part_of = whole.filter("kind = 'part'").select("uid", "block", "side", "depth")

    ends = rows.filter("kind = 'ends'").select("block", "side", "depth", "conv_id", "ids").join(part_of, ["block", "side", "depth"])
    digests = ends.repartition("uid").sortWithinPartitions("uid", "conv_id").select("uid", "ids").mapInArrow(ends_hashed, "uid long, digest string")
    shared = spine.join(low, "parent_uid", "left").join(digests, "uid", "left").withColumn("ends_sha256", F.coalesce("digest", F.lit(NO_ENDS)))

    closed = rows.filter("kind = 'node'")
    known = closed.filter("parent_side IS NULL")
    lows = part_of.join(low, part_of.uid == low.parent_uid).select(
        "block", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), F.col("parent_conv_id").alias("low")
    )
    hung = closed.filter("parent_side IS NOT NULL").join(lows, ["block", "parent_side", "depth"]).withColumn("parent_conv_id", F.col("low"))
    return known.select(*RESULT).unionByName(hung.select(*RESULT)).unionByName(shared.select(*RESULT))
