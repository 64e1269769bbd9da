"""Mixing sources to target weights by Pareto order sampling.

A source's target is a share of the whole budget in proportion to its weight, at most
`most` times its own size; what is cut off is shared again by weight until no target is above its limit.

A document of a source with target T and size S is wanted T / S times. The whole part is certain: every document is
taken that often. For the fraction f that is left, documents are ranked by their random odds
divided by their inclusion odds, u / (1 - u) : f / (1 - f), and taken in that order until the source's words reach the target;
the document at the cut is taken if that comes nearer to it. The sample has a fixed size in words, and unequal
inclusion probabilities come from the sources' fractions, or from `emphasis`, which multiplies a document's odds.

The order is cut in two steps: sums over `SLOTS` intervals of the ranking variable per source, then a running sum
over the documents of the one interval that holds the cut. No task sorts a source.

Random numbers are functions of the seed and the id, so reruns agree.

Defined results: a null or blank text has size 0 and takes 0 words; a null id gets a number from its text instead;
rows that repeat an id and text tie, and any one of them may be the one at the cut. A null source is a source, the last
one. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.tables import materialise

SLOTS = 65536
DIGITS = 13  # hex digits of a digest: 52 bits, exact in a double


def n_words(text: Column) -> Column:
    """Number of words parted by ASCII white space."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    return F.regexp_count(plain, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """In (0, 1), from the digest of seed and key."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary")), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16**DIGITS))


def targets(sizes: DataFrame, weights: Sequence[int], share: int, most: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size); `share` is the budget in percent of all words.

    Sources by code point, null last, weigh `weights` in turn. Limits are reached in order of limit / weight: with the
    first k at their limit, the others share the rest by weight, and the first k whose level stays below the next limit is right.
    """
    ordered = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights)))
    weighed = sizes.select(
        "source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long").alias("weight")
    )
    by_limit = W.orderBy((F.lit(most) * F.col("source_size") / F.col("weight")), F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_limit.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    level = (
        (F.sum("source_size").over(whole) * share) / F.lit(100.0)
        - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    leveled = weighed.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= F.lit(most) * F.col("source_size"))
    # Levels rise as long as the next source is over its limit, and fall afterwards: the first that fits is the largest that does.
    found = F.max(F.when(F.col("fits"), F.col("level"))).over(whole)
    limit = (F.lit(most) * F.col("source_size")).cast("double")
    return leveled.withColumn("found", found).select(
        "source", "source_size", F.least(limit, F.coalesce(F.col("found") * F.col("weight"), limit)).alias("target")
    )


def mixed(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: int = 150, most: int = 2, seed: int = 7,
    emphasis: Column | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, *keep) for every row of (doc_id, text, source)."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    rows = docs.select(
        "doc_id", n_words(F.col("text")).alias("size"), F.col("source").cast("string").alias("source"),
        uniform(key, seed).alias("u"), (emphasis if emphasis is not None else F.lit(1.0)).cast("double").alias("emphasis"),
        *([F.struct(*keep).alias("kept")] if keep else []),
    )
    sized = materialise(rows, "mix-sizes")
    aims = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    aims = materialise(
        aims.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumnRenamed("source", "of"),
        "mix-targets",
    )
    part = F.col("rest") / F.col("source_size")
    odds = (F.col("u") / (1 - F.col("u"))) / (part / (1 - part) * F.col("emphasis"))
    ranked = (
        sized.join(aims, sized["source"].eqNullSafe(aims["of"])).drop("of")
        .withColumn("odds", F.when(F.col("rest") > 0, odds))
        .withColumn("slot", F.floor(F.col("odds") / (1 + F.col("odds")) * SLOTS).cast("int"))
    )
    running = W.partitionBy("of").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    sums = (
        ranked.filter("rest > 0").groupBy(F.col("source").alias("of"), "slot", "rest").agg(F.sum("size").alias("words"))
        .withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    )
    cuts = sums.filter("before < rest AND before + words >= rest").select(
        F.col("of").alias("cut_of"), F.col("slot").alias("cut_slot"), F.col("before").alias("cut_before")
    )
    placed = ranked.join(cuts, F.col("source").eqNullSafe(F.col("cut_of")), "left")
    clear = placed.filter("cut_slot IS NULL OR slot IS NULL OR slot <> cut_slot").withColumn(
        "more", F.when(F.col("rest") > 0, F.coalesce(F.col("slot") < F.col("cut_slot"), F.lit(True))).otherwise(F.lit(False)).cast("long")
    )
    inside = W.partitionBy("source", "slot").orderBy("odds", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    reached = F.col("cut_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    near = placed.filter("slot = cut_slot").withColumn("reached", reached).withColumn(
        "more", ((F.col("reached") < F.col("rest")) & (2 * (F.col("rest") - F.col("reached")) > F.col("size"))).cast("long")
    ).drop("reached")
    return clear.unionByName(near).select(
        "doc_id", "size", "source_size", "target", ((F.col("whole") + F.col("more")) * F.col("size")).alias("taken"),
        (F.col("whole") + F.col("more")).alias("copies"), *(F.col(f"kept.{c}").alias(c) for c in keep),
    )
