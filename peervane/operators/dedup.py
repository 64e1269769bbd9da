"""Distinct-on, unions and set differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

def last_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last whole row of each key, nulls included.

    Spark limits each key to one row per map task before the shuffle, so a key
    that repeats without end costs one row per map task.
    """
    w = W.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
    return frame.withColumn("_place", F.row_number().over(w)).filter("_place = 1").drop("_place")


def distinct_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    return frame.select(*keys).distinct()


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second).distinct()


def except_keys(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the first table whose key the second does not hold."""
    return first.join(second.select(*keys), list(keys), "left_anti")


def fill_gaps(primary: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All of the primary table, then what only the fallback knows.

    Both meet in one shuffle by key and are read once, since what makes them may be a scan and an aggregate of
    raw rows. A null key equals no other, so its rows all stay.
    """
    both = primary.withColumn("_turn", F.lit(0)).unionByName(fallback.withColumn("_turn", F.lit(1)))
    known = both.withColumn("_first", F.min("_turn").over(W.partitionBy(*keys)))
    unkeyed = F.array_contains(F.array(*[F.col(k).isNull() for k in keys]), True)
    return known.filter((F.col("_turn") == F.col("_first")) | unkeyed).drop("_turn", "_first")
