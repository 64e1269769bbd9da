"""Exact ranks and quantiles that hold when one group owns the whole table.

Equal values are counted before anything is ordered. The distinct values of all groups are then sorted in ranges and stored with the number
of their range; each range is summed on its own, and the few range totals of a group are summed in order. A group spans as many
ranges as it needs, so no task orders a whole group, at any size: there is no other path for small tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peervane.session import materialise


def distinct_values(frame: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n): how often each value occurs in its group; nulls are left out.

    Equal values collapse on the map side, so a value a third of the rows share
    is one row per map task.
    """
    return frame.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def value_counts(frame: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n, below, total): rows at and under each distinct value of its group.

    The sorted ranges are stored, so a retried task sees the same ranges. A window here holds one range of one
    group, or a row per range.
    """
    keys = list(keys)
    sorted_ranges = distinct_values(frame, keys, value).repartitionByRange(*keys, value)
    counts = materialise(sorted_ranges.withColumn("_range", F.spark_partition_id()), "value-counts")
    per_range = counts.groupBy(*keys, "_range").agg(F.sum("n").alias("_n"))
    w = W.partitionBy(*keys)
    upto = F.sum("_n").over(w.orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow))
    offsets = per_range.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_k_range"), (upto - F.col("_n")).alias("_before"),
        F.sum("_n").over(w).alias("total"),
    )
    inside = W.partitionBy(*keys, "_range").orderBy(value)
    upto = F.sum("n").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow))
    same = same_keys(keys) & (F.col("_range") == F.col("_k_range"))
    return counts.withColumn("_inside", upto - F.col("n")).join(offsets, same).select(
        *keys, value, "n", (F.col("_before") + F.col("_inside")).alias("below"), "total"
    )


def same_keys(keys: Sequence[str]) -> Column:
    """Whether keys equal their `_k_` copies, null keys included."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.lit(True))


def quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, named: Mapping[str, float]
) -> DataFrame:
    """Exact quantiles with linear interpolation, from `value_counts`."""
    reach = F.col("below") + F.col("n")
    parts: list[Column] = []
    for name, p in named.items():
        place = (F.col("total") - 1) * F.lit(float(p))
        parts.append(F.min(F.when(reach > F.floor(place), F.col(value))).alias(f"_low_{name}"))
        parts.append(F.min(F.when(reach > F.ceil(place), F.col(value))).alias(f"_high_{name}"))
    parts.append(F.max("total").alias("total"))
    found = counts.groupBy(*keys).agg(*parts)
    columns = []
    for name, p in named.items():
        place = (F.col("total") - 1) * F.lit(float(p))
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        columns.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select(*keys, *columns)


def dispersion(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of rows off the most common value, from `distinct_values` or `value_counts`."""
    return counts.groupBy(*keys).agg((1 - F.max("n") / F.sum("n")).alias("dispersion"))


def average_rank(frame: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Ascending rank from 1 within `keys`, ties sharing their mean rank; null stays null.

    Ranks come from `value_counts` and a join back on the value; a value many rows share is a skewed key
    there, which AQE splits.
    """
    keys = list(keys)
    ranks = value_counts(frame, keys, value).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col(value).alias("_value"),
        (F.col("below") + (F.col("n") + 1) / F.lit(2.0)).alias(name),
    )
    same = same_keys(keys) & (F.col(value) == F.col("_value"))
    return frame.join(ranks, same, "left").drop("_value", *[f"_k_{k}" for k in keys])
