"""Joins that may not change a row count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RepeatedKeyError(ValueError):
    """A dimension holds a key more than once and would multiply rows."""


def repeated_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def assert_unique(frame: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key repeats. One job, one row to the driver."""
    worst = repeated_keys(frame, keys).orderBy(F.desc("n")).limit(1).collect()
    if worst:
        raise RepeatedKeyError(f"{list(keys)} repeats: {worst[0].asDict()}")


def left_join_keeping_rows(
    left: DataFrame, right: DataFrame, keys: Sequence[str], check: bool = True
) -> DataFrame:
    """A left join against a table that must hold each key at most once."""
    if check:
        assert_unique(right, keys)
    return left.join(right, list(keys), "left")


def without_overlap(frame: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the columns both tables carry, so that a join has no ambiguous name."""
    return frame.drop(*[c for c in other.columns if c in frame.columns and c not in keys])
