"""Merkle manifest: a root over every record of every source, and a proof per record.

Leaves of a source are ranked (by id, then digest). The base-`ARITY` digits of a rank are the way from the leaf to the root: the rank without
its last digit names the parent. A block is `DIGITS` levels, so at most ARITY**DIGITS leaves; inside a block the digits are grouped away one
after the other, each time nesting the children as structs in their parent, all under one shuffle by (tree, block). The digests of blocks are
the leaves of the next storey, until one node per source is left; the subroots are a last tree of the same kind. Going down, a block gets the
proof above it by one aggregation with its storey (no join), and nested transforms and an explode turn it into the proofs of its leaves.

No row holds more than a block, and only digests move: texts are read once and never shuffled.

Defined results: nulls are digested as `-`, so a null text differs from an empty one; null ids come first and are never tampered with; a null
source is a source of its own and comes first; equal ids are ordered by digest, so repeated rows are leaves of their own (equal ones may
trade places, which no digest shows). A source of one record has that leaf as its subroot. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.tables import materialise

ARITY = 3
DIGITS = 6
PATH = "array<struct<left:string,right:string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    plain = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain), F.lit("-"))


def record_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def ranked(nodes: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """`nodes` with `rank` (from 0) and `n` within each `tree`, whatever its size.

    Rows are sorted in ranges and stored with their place; a rank is the place in the range plus the rows of
    the tree in the ranges before. The window runs over one row per (tree, range).
    """
    placed = nodes.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    stored = materialise(
        placed.withColumn("range", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()), "merkle-ranks"
    )
    ranges = stored.groupBy(tree, "range").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("held"))
    along = W.partitionBy(tree).orderBy("range")
    starts = ranges.select(
        F.col(tree).alias("_tree"), F.col("range").alias("_range"), "first",
        F.coalesce(F.sum("held").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("held").over(W.partitionBy(tree)).alias("n"),
    )
    same = F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("range") == F.col("_range"))
    return stored.join(starts, same).withColumn("rank", F.col("before") + F.col("place") - F.col("first")).drop(
        "_tree", "_range", "range", "place", "first", "before"
    )


def nested(leaves: DataFrame) -> DataFrame:
    """(tree, block, n, digest, kids): the blocks over leaves (tree, rank, n, digest, item).

    A tree of n leaves has no more than the levels that make one node of them: above, a node passes through
    with its digest unchanged. `kids` nests (digit, digest, kids) down to (digit, digest, item).
    """
    base = F.lit(ARITY)
    digits = [f"d{level}" for level in range(DIGITS)]
    split = leaves.select(
        "tree", F.floor(F.col("rank") / base**DIGITS).cast("long").alias("block"), "n", "digest", F.col("item").alias("kids"),
        *(F.pmod(F.floor(F.col("rank") / ARITY**level), base).cast("int").alias(d) for level, d in enumerate(digits)),
    ).repartition("tree", "block")
    for level, digit in enumerate(digits):
        child = F.struct(F.col(digit).alias("digit"), "digest", "kids")
        split = split.groupBy("tree", "block", "n", *digits[level + 1 :]).agg(F.array_sort(F.collect_list(child)).alias("kids"))
        above = F.col("n") <= ARITY**level
        split = split.withColumn(
            "digest", F.when(above, F.col("kids")[0]["digest"]).otherwise(F.sha2(F.concat_ws("", F.col("kids")["digest"]), 256))
        )
    return split


def leaf_proofs(kids: Column, n: Column, above: Column, level: int) -> Column:
    """All (item, digest, path) of a block, as one array; `path` is an array of (left, right) digests, from the leaf upwards."""

    def down(kid: Column, place: Column) -> Column:
        side = lambda keep: F.concat_ws("", F.transform(F.filter(kids, keep), lambda k: k["digest"]))
        step = F.struct(
            side(lambda k: k["digit"] < kid["digit"]).alias("left"), side(lambda k: k["digit"] > kid["digit"]).alias("right")
        )
        path = F.concat(F.when(n > ARITY**level, F.array(step)).otherwise(F.array().cast(PATH)), above)
        if level:
            return leaf_proofs(kid["kids"], n, path, level - 1)
        return F.array(F.struct(kid["kids"].alias("item"), kid["digest"].alias("digest"), path.alias("path")))

    return F.flatten(F.transform(kids, down))


def storeys(leaves: DataFrame) -> list[DataFrame]:
    """Stored blocks, the lowest storey first; the last has one block for each tree."""
    built = []
    while True:
        built.append(materialise(nested(leaves), "merkle-blocks"))
        # One number to the driver: the most blocks that a tree still has.
        if (built[-1].agg(F.max("block")).first()[0] or 0) == 0:
            return built
        leaves = built[-1].select(
            "tree", F.col("block").alias("rank"), F.ceil(F.col("n") / ARITY**DIGITS).cast("long").alias("n"), "digest",
            F.col("block").alias("item"),
        )


def handed_down(blocks: DataFrame, tops: DataFrame) -> DataFrame:
    """(tree, item, digest, path, subroot, root) of what lies in `blocks`, given (tree, block, path, subroot, root) of every block.

    Each (tree, block) has two rows here, its content and its proof, and one aggregation puts them together.
    """
    types = dict(blocks.dtypes)
    content = blocks.select("tree", "block", "n", "kids", *(F.lit(None).cast(t).alias(c) for c, t in (("path", PATH), ("subroot", "string"), ("root", "string"))))
    proof = tops.select("tree", "block", F.lit(None).cast("long").alias("n"), F.lit(None).cast(types["kids"]).alias("kids"), "path", "subroot", "root")
    whole = content.unionByName(proof).groupBy("tree", "block").agg(
        *(F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", "subroot", "root"))
    )
    return whole.select(
        "tree", "subroot", "root", F.explode(leaf_proofs(F.col("kids"), F.col("n"), F.col("path"), DIGITS - 1)).alias("leaf")
    ).select("tree", "leaf.item", "leaf.digest", "leaf.path", "subroot", "root")


def proofs(leaves: DataFrame) -> DataFrame:
    """(tree, item, digest, path, subroot, root) for every leaf (tree, rank, n, digest, item); the subroots of all trees lead to the root."""
    built = storeys(leaves)
    crowns = built[-1].select("tree", "digest")
    groves = ranked(crowns.withColumn("grove", F.lit(0)), "grove", ["tree"]).select(
        F.col("grove").alias("tree"), "rank", "n", "digest", F.col("tree").alias("item")
    )
    over = storeys(groves)
    none = F.lit(None).cast("string")
    known = over[-1].select("tree", "block", F.array().cast(PATH).alias("path"), none.alias("subroot"), F.col("digest").alias("root"))
    for storey in reversed(over[1:]):
        known = handed_down(storey, known).select("tree", F.col("item").alias("block"), "path", "subroot", "root")
    sources = handed_down(over[0], known)
    known = sources.select(F.col("item").alias("tree"), F.lit(0).cast("long").alias("block"), "path", F.col("digest").alias("subroot"), "root")
    for storey in reversed(built[1:]):
        known = handed_down(storey, known).select("tree", F.col("item").alias("block"), "path", "subroot", "root")
    return handed_down(built[0], known)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def manifest(docs: DataFrame, presented: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, path, subroot, root, folded_root, verified) per record.

    `presented` is the text as it is found when the manifest is checked, the recorded one if none is given: `folded_root` comes from the
    record with that text and the recorded siblings, and `verified` tells whether it is the root.
    """
    fields = [F.col(c) for c in FIELDS]
    shown = F.col("text") if presented is None else presented
    digests = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), record_digest(fields).alias("leaf"),
        record_digest([*fields[:-1], shown]).alias("shown"),
    )
    # The place of a row only spreads rows that are equal in all else.
    stored = materialise(digests.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    leaves = ranked(stored, "source", ["doc_id", "leaf", "row"]).select(
        F.col("source").alias("tree"), "rank", "n", F.col("leaf").alias("digest"), F.struct("doc_id", "shown").alias("item")
    )
    found = proofs(leaves).withColumn("folded_root", folded(F.col("item.shown"), F.col("path")))
    return found.select(
        "item.doc_id", F.col("tree").alias("source"), F.col("digest").alias("leaf"), "path", "subroot", "root", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def siblings(path: Column) -> Column:
    """All siblings of a path in one string, level by level, left to right."""
    return F.concat_ws("", F.transform(path, lambda step: F.concat(step["left"], step["right"])))
