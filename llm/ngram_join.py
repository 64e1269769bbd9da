"""N-gram Jaccard join over count vectors.

Every document is a set of k-word shingles. Two sets of sizes x and y whose
Jaccard similarity is at least t share at least t / (1 + t) * (x + y) shingles,
so at most d = (1 - t) / (1 + t) * (x + y) shingles are in only one of them.

1. *Count vectors.* Shingles are hashed into groups. The group counts of a
   document are a point, and the summed coordinate minima of two points bound
   the overlap of their sets from above.
2. *Blocks.* To place points that can be near on the same machine, shingles are
   also hashed into more groups than d; then two linked sets agree on the whole
   content of at least one group. A document sends one key per group, small groups left out as far as the others suffice, and only
   documents with an equal key ever meet. The number of groups depends on the
   size class, and a set at the edge of its class sends the keys of the next one too.
   Keys of up to `TOGETHER` documents are merged before the shuffle.
3. *First links.* Every member of a block is compared with the first member,
   which is linear and joins whole families of near copies.
4. *R-trees.* Blocks that still hold members of different components are
   joined exactly: a tree of bounding boxes over their points is descended with itself,
   leaving out pairs of nodes whose bound is too low or that lie in one component. A block of
   over `TILE` members is dealt out in tiles, every pair of tiles to a task, so no task holds a whole hot block.
5. Surviving pairs are verified on the shingle sets of the whole texts, and links become connected components.

Nothing is capped: a pair leaves only by a bound that proves it too far apart.

Defined results: null or empty texts and texts without words have no shingles and are
linked with nothing; texts of fewer than k words are one shingle. A null id gives a row with a
null component that is linked with nothing. Rows that repeat an id are rows of one document id: each has its
own size, and a link of any of them counts for all. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import components, groups_of, materialise
from llm.textkit import mix64, shingle_sets, slices

#: Axes of the trees; a document of many shingles has a finer point too, with at most `PER_AXIS` shingles an axis on average.
AXES = 256
FINEST = 1 << 15
PER_AXIS = 1
TILE = 2048
LEAF = 32
FANOUT = 8
MARKS = 16
TOGETHER = 1000

POINTS = (
    "doc_id long, n_shingles long, node long, counts binary, fine binary, keys array<long>, "
    "tied_keys array<long>, tied_heads array<long>"
)


def class_edges(limit: int = 1 << 40) -> list[int]:
    """Smallest set size of each size class."""
    edges = [1]
    while edges[-1] < limit:
        edges.append(max(edges[-1] + 1, edges[-1] * 5 // 4))
    return edges


EDGES = class_edges()


def block_keys(hashes: np.ndarray, num: int, den: int) -> np.ndarray:
    """The keys of one sorted shingle set, for similarity num / den."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    own = int(np.searchsorted(EDGES, n, "right")) - 1
    content = mix64(hashes)
    high = hashes >> np.uint64(32)
    keys = []
    c = own
    while c == own or EDGES[c] * num <= n * den:
        top = EDGES[c + 1] - 1
        differ = 2 * top * (den - num) // (den + num)
        groups = (differ + 1) * 3 // 2 + 1
        group = (high * np.uint64(groups)) >> np.uint64(32)
        firsts = np.flatnonzero(np.diff(group, prepend=np.uint64(groups)))
        sums, used = np.add.reduceat(content, firsts), group[firsts]
        # At least groups - differ contents agree. As many as the others may be left out, the smallest first: both sets
        # leave out agreeing groups by the same sizes, and one that neither leaves out remains.
        spare, empty = groups - differ - 1, groups - len(used)
        if empty > spare:
            whole = np.zeros(groups, np.uint64)
            whole[used] = sums
            used, sums = np.arange(groups, dtype=np.uint64), whole
        else:
            sizes = np.diff(firsts, append=n)
            small = empty + np.cumsum(np.bincount(sizes))
            large = sizes >= np.searchsorted(small, spare, "right")
            used, sums = used[large], sums[large]
        keys.append(mix64(sums ^ mix64(used + np.uint64(c << 40))))
        c += 1
    return np.concatenate(keys)


def point_of(hashes: np.ndarray) -> bytes:
    """Group counts of a set, on a power of two of axes that grows with it; the first byte is the width of a count."""
    axes = AXES
    while axes < FINEST and axes * PER_AXIS < len(hashes):
        axes *= 2
    return packed_counts(np.bincount((hashes & np.uint64(axes - 1)).astype(np.int64), minlength=axes))


def packed_counts(counts: np.ndarray) -> bytes:
    width = 1 if counts.max() < 256 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def counts_in(point: bytes, axes: int | None = None) -> np.ndarray:
    """The group counts of a point, folded to fewer axes if asked: groups are low bits of the hash, so halves add up."""
    counts = np.frombuffer(point, f"<u{point[0]}", offset=1).astype(np.int32)
    return counts if axes is None else counts.reshape(-1, axes).sum(0)


def stacked(points: list[bytes]) -> np.ndarray:
    """Points of `AXES` axes as rows of one array, in bytes while all counts are that small."""
    if all(p[0] == 1 for p in points):
        return np.frombuffer(b"".join(points), np.uint8).reshape(len(points), AXES + 1)[:, 1:]
    return np.stack([counts_in(p) for p in points])


def shared_at_most(one: bytes, two: bytes) -> int:
    """The summed coordinate minima of two points on the axes that both have."""
    x, y = counts_in(one), counts_in(two)
    axes = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, axes).sum(0), y.reshape(-1, axes).sum(0)).sum())


def point_rows(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """One row per document: its size, its point, and the keys it has to send; keys are merged within `TOGETHER` documents."""
    for batch in (b.slice(at, TOGETHER) for b in batches for at in range(0, b.num_rows, TOGETHER)):
        ids = batch.column(0).to_pylist()
        sizes = np.zeros(len(ids), np.int64)
        marks: list[bytes | None] = [None] * len(ids)
        fine: list[bytes | None] = [None] * len(ids)
        least: dict[bytes, int] = {}
        sent: dict[bytes, np.ndarray] = {}
        for at, words in slices(batch.column(1)):
            for i, s in enumerate(shingle_sets(words, k), at):
                sizes[i] = len(s)
                if not len(s) or ids[i] is None:
                    continue
                mark = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                marks[i] = mark
                if mark not in least:
                    sent[mark] = block_keys(s, num, den)
                least[mark] = min(ids[i], least.get(mark, ids[i]))
                fine[i] = point_of(s)
        nodes = [None if m is None else least[m] for m in marks]
        order = sorted(sent, key=least.__getitem__)
        lengths = [len(sent[m]) for m in order]
        owner = np.repeat(np.array([least[m] for m in order], np.int64), lengths)
        keys = np.concatenate([sent[m] for m in order]) if order else np.zeros(0, np.uint64)
        by_key = np.argsort(keys, kind="stable")
        repeats = np.zeros(len(keys), bool)
        repeats[by_key[1:]] = keys[by_key[1:]] == keys[by_key[:-1]]
        run = np.cumsum(~repeats[by_key]) - 1
        heads = np.empty(len(keys), np.int64)
        if len(keys):
            heads[by_key] = owner[by_key[np.flatnonzero(~repeats[by_key])]][run]
        keys = keys.view(np.int64)
        place = {m: (int(e) - n, int(e)) for m, n, e in zip(order, lengths, np.cumsum(lengths))}
        lists: list[list] = [[], [], []]
        for mark, i, node in zip(marks, ids, nodes):
            if mark is None or i != node or mark not in place:
                for x in lists:
                    x.append(None)
                continue
            a, b = place.pop(mark)
            tied = repeats[a:b]
            lists[0].append(keys[a:b][~tied])
            lists[1].append(keys[a:b][tied])
            lists[2].append(heads[a:b][tied])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array(sizes), pa.array(nodes, pa.int64()),
                pa.array([None if f is None else packed_counts(counts_in(f, AXES)) for f in fine], pa.binary()), pa.array(fine, pa.binary()),
                *(pa.array(x, pa.list_(pa.int64())) for x in lists),
            ],
            names=["doc_id", "n_shingles", "node", "counts", "fine", "keys", "tied_keys", "tied_heads"],
        )


def tie_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, head, node) for every row of a sorted stream that is not the first of its key."""
    last_key, head = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.empty(len(key), bool)
        new[0] = key[0] != last_key
        new[1:] = key[1:] != key[:-1]
        at = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        heads = np.where(at >= 0, node[at], node[0] if head is None else head)
        last_key, head = key[-1], heads[-1]
        keep = ~new & (heads != node)
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[keep]), pa.array(heads[keep]), pa.array(node[keep])], names=["key", "head", "node"]
            )


def least_overlap(total: np.ndarray | int, num: int, den: int):
    """The smallest overlap of two sets of `total` shingles that can be linked."""
    return -(-num * total // (num + den))


class Node:
    """A box over points: upper corner, smallest size, and the component if there is only one."""

    __slots__ = ("high", "least", "only", "parts", "rows")

    def __init__(self, high, least, only, parts, rows):
        self.high, self.least, self.only, self.parts, self.rows = high, least, only, parts, rows


def bulk_load(points: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> Node:
    """A packed R-tree: rows sorted by size, then tiles cut along the widest axis, level by level."""

    def leaf(rows):
        one = labels[rows[0]] if (labels[rows] == labels[rows[0]]).all() else None
        return Node(points[rows].max(0), sizes[rows].min(), one, None, rows)

    def build(rows):
        if len(rows) <= LEAF:
            return leaf(rows)
        spread = np.ptp(points[rows], axis=0)
        ranked = rows[np.lexsort((points[rows][:, int(spread.argmax())], labels[rows]))]
        parts = [build(x) for x in np.array_split(ranked, min(FANOUT, -(-len(rows) // LEAF)))]
        only = parts[0].only if all(p.only is not None and p.only == parts[0].only for p in parts) else None
        return Node(np.max([p.high for p in parts], 0), min(p.least for p in parts), only, parts, None)

    return build(np.arange(len(points)))


def tree_pairs(a: Node, b: Node, points, sizes, labels, num, den) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, one below each node, that lie in different components and may be linked."""
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if x.only is not None and y.only is not None and x.only == y.only:
            continue
        if int(np.minimum(x.high, y.high).sum()) < least_overlap(int(x.least) + int(y.least), num, den):
            continue
        if x.parts is None and y.parts is None:
            shared = np.minimum(points[x.rows][:, None, :], points[y.rows][None, :, :]).sum(2, dtype=np.int64)
            need = least_overlap(sizes[x.rows][:, None] + sizes[y.rows][None, :], num, den)
            near = (shared >= need) & (labels[x.rows][:, None] != labels[y.rows][None, :])
            if x is y:
                near &= np.tri(len(x.rows), k=-1, dtype=bool)
            i, j = np.nonzero(near)
            if len(i):
                yield x.rows[i], y.rows[j]
        elif x is y:
            stack += [(p, q) for n, p in enumerate(x.parts) for q in x.parts[n:]]
        elif y.parts is None or (x.parts is not None and len(x.parts) >= len(y.parts)):
            stack += [(p, y) for p in x.parts]
        else:
            stack += [(x, q) for q in y.parts]


def block_pairs(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Candidates of every block, or of every pair of tiles of a large one.

    A pair that shares one of the first blocks of both its members is left to that block.
    """
    for rows in groups_of(batches, ["key", "left", "right"]):
        left, right = rows.column("left")[0].as_py(), rows.column("right")[0].as_py()
        if left != right:
            rows = rows.sort_by([("tile", "ascending")])
        node, label, size = (rows.column(c).to_numpy() for c in ("node", "component", "n_shingles"))
        points = stacked(rows.column("counts").to_pylist())
        earlier = [frozenset(x) for x in rows.column("earlier").to_pylist()]
        if left == right:
            one = two = bulk_load(points, size, label)
        else:
            m = int((rows.column("tile").to_numpy() == left).sum())
            if m in (0, len(node)):
                continue
            one = bulk_load(points[:m], size[:m], label[:m])
            two = bulk_load(points[m:], size[m:], label[m:])
            shift(two, m)
        for i, j in tree_pairs(one, two, points, size, label, num, den):
            here = np.array([earlier[x].isdisjoint(earlier[y]) for x, y in zip(i, j)], bool)
            if here.any():
                x, y = node[i[here]], node[j[here]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def shift(tree: Node, by: int) -> None:
    if tree.parts is None:
        tree.rows = tree.rows + by
    else:
        for p in tree.parts:
            shift(p, by)


def near_points(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose summed coordinate minima reach the overlap that a link needs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        points = zip(batch.column("fine_a").to_pylist(), batch.column("fine_b").to_pylist())
        shared = np.array([shared_at_most(one, two) for one, two in points], np.int64)
        total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        near = shared >= least_overlap(total, num, den)
        yield pa.RecordBatch.from_arrays(
            [pa.array(batch.column(c).to_numpy()[near]) for c in ("a", "b")], names=["a", "b"]
        )


def linked_rows(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose shingle sets are as similar as asked; equal neighbouring texts are hashed once."""
    for batch in batches:
        sets = []
        for name in ("text_a", "text_b"):
            texts = batch.column(name).to_pylist()
            new = [i for i, t in enumerate(texts) if not i or t != texts[i - 1]]
            parted = pa.array([texts[i] for i in new], pa.large_string())
            found = [s for _, words in slices(parted) for s in shingle_sets(words, k)]
            index = np.cumsum(np.isin(np.arange(len(texts)), new)) - 1
            sets.append((found, index))
        keep = []
        for (xs, xi), (ys, yi) in [sets]:
            for i in range(batch.num_rows):
                x, y = xs[xi[i]], ys[yi[i]]
                small, big = (x, y) if len(x) < len(y) else (y, x)
                if not len(small):
                    continue
                at = np.searchsorted(big, small)
                both = int((big[np.minimum(at, len(big) - 1)] == small).sum())
                if den * both >= num * (len(x) + len(y) - both):
                    keep.append(i)
        yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], names=["a", "b"])


def bounded(pairs: DataFrame, points: DataFrame, num: int, den: int) -> DataFrame:
    """The candidate pairs (a, b) whose points may be near enough."""
    at = lambda s: points.select(F.col("node").alias(s), F.col("fine").alias(f"fine_{s}"), F.col("n_shingles").alias(f"n_{s}"))
    near = pairs.join(at("a"), "a").join(at("b"), "b")
    return near.mapInArrow(partial(near_points, num=num, den=den), "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The linked ones of bounded pairs (a, b), compared as sets."""
    side = lambda s: texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"text_{s}"))
    # Sorted joins at every size: pairs are few, texts are many, and a text with very many pairs can be split.
    full = pairs.hint("merge").join(side("b"), "b").hint("merge").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(partial(linked_rows, k=k, num=num, den=den), "a long, b long").distinct()


def same_ids(rows: DataFrame) -> DataFrame:
    """(a, b): what ties the texts of an id that has several, where they stand for different nodes; links of any row count for all rows of its id."""
    several = rows.filter("node IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    tied = rows.select("doc_id", "node").join(several.select("doc_id", "low"), "doc_id").filter("node > low")
    return tied.select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """(doc_id, n_shingles, component_id) of documents (doc_id, text), linked at Jaccard num / den or more."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = materialise(texts.mapInArrow(partial(point_rows, k=k, num=num, den=den), POINTS), "points")
    points = rows.filter("node = doc_id").select("node", "n_shingles", "counts", "fine").dropDuplicates(["node", "fine"])

    sent = rows.select(F.explode("keys").alias("key"), "node")
    across = sent.repartition("key").sortWithinPartitions("key", "node").mapInArrow(tie_rows, "key long, head long, node long")
    within = rows.filter("size(tied_keys) > 0").select(
        "node", F.explode(F.arrays_zip("tied_keys", "tied_heads")).alias("t")
    ).select(F.col("t.tied_keys").alias("key"), F.col("t.tied_heads").alias("head"), "node").filter("head <> node")
    ties = materialise(across.unionByName(within), "ties")

    stars = ties.select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")).distinct()
    stars = materialise(stars, "star-pairs")
    links = materialise(verified(bounded(stars, points, num, den), texts, k, num, den), "star-links")
    found = materialise(components(links), "star-components")

    named = lambda s: found.select(F.col("node").alias(s), F.col("component").alias(f"{s}_component"))
    labelled = (
        ties.join(named("head"), "head", "left").join(named("node"), "node", "left")
        .select(
            "key", "head", "node",
            F.coalesce("head_component", "head").alias("head_component"),
            F.coalesce("node_component", "node").alias("node_component"),
        )
    )
    split = (
        labelled.groupBy("key")
        .agg(F.count(F.lit(1)).alias("ties"), F.max(F.expr("head_component <> node_component")).alias("open"))
        .filter("open AND ties > 1")
        .select("key")
    )
    members = (
        labelled.join(split, "key")
        .select("key", F.inline(F.array(
            F.struct(F.col("head").alias("node"), F.col("head_component").alias("component")),
            F.struct(F.col("node").alias("node"), F.col("node_component").alias("component")),
        )))
        .distinct()
    )
    members = materialise(members, "open-blocks")
    # Blocks with the same members are the same block.
    sizes = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark")
    )
    blocks = sizes.groupBy("members", "mark").agg(F.min("key").alias("key")).select(
        "key", F.ceil(F.col("members") / TILE).cast("int").alias("tiles")
    )
    # The first few blocks a member is in: a pair that shares one of them is taken up there. It saves repeats and loses no pair.
    kept = members.join(blocks, "key")
    marks = kept.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("key")), 1, MARKS).alias("marks"))
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    dealt = (
        kept.join(points.drop("fine"), "node").join(marks, "node")
        .withColumn("earlier", F.filter("marks", lambda k: k < F.col("key")))
        .withColumn("tile", tile)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "key", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"),
            "tile", "node", "component", "n_shingles", "counts", "earlier",
        )
    )
    grouped = dealt.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right")
    more = grouped.mapInArrow(partial(block_pairs, num=num, den=den), "a long, b long").distinct()
    more = materialise(more.join(stars, ["a", "b"], "left_anti"), "tree-pairs")
    every = links.unionByName(verified(bounded(more, points, num, den), texts, k, num, den)).unionByName(same_ids(rows))
    final = components(every)
    return (
        rows.select("doc_id", "n_shingles", "node")
        .join(final, "node", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "node", "doc_id").alias("component_id"))
    )
