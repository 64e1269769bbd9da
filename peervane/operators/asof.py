"""Filings in force on a date, and the coalescing of two filings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peervane.operators.dedup import fill_gaps, last_per_key


def in_force(
    filings: DataFrame, key: str, ts: str, reference, tie_break: Sequence[Column] = ()
) -> DataFrame:
    """The latest filing at or before the reference date, nulls and all."""
    known = filings.filter(F.col(ts).isNotNull() & (F.col(ts) <= F.lit(reference)))
    return last_per_key(known, [key], [F.col(ts), *tie_break])


def combine_terms(
    primary: DataFrame, fallback: DataFrame, key: str, required: Sequence[str],
    labels: tuple[str, str], source: str = "source", order: Sequence[Column] = (),
) -> DataFrame:
    """Complete terms of the primary filing, then of the fallback where it is silent."""

    def prepare(frame: DataFrame, label: str) -> DataFrame:
        for column in required:
            frame = frame.filter(F.col(column).isNotNull())
        if order:
            frame = last_per_key(frame, [key], list(order))
        return frame.withColumn(source, F.lit(label))

    return fill_gaps(prepare(primary, labels[0]), prepare(fallback, labels[1]), [key])
