"""Small helpers that several operators share: stored tables, connected components, streams of sorted rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peervane.session import materialise, passing_tables

__all__ = ["components", "groups_of", "materialise", "passing_tables", "shuffles_released", "table"]

RELEASE_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_released(spark) -> Iterator[None]:
    """Within it, shuffle files go as soon as the table they made is stored, and do not wait for the driver to forget the plan."""
    before = spark.conf.get(RELEASE_SETTING, None)
    spark.conf.set(RELEASE_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE_SETTING) if before is None else spark.conf.set(RELEASE_SETTING, before)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node on a link (a, b); a component is named by its smallest node.

    Large-star and small-star rounds: in turn every node sends its larger
    neighbours, then itself and its smaller ones, to the smallest node it knows. Both are
    aggregations with partial minima followed by a join, so a node that is on
    a third of all links is summed before the shuffle and its join side can be
    split. Each round is a stored table, and the rounds end when all of its edges are stars;
    the driver sees one number of it.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    while True:
        edges = materialise(edges, "star-edges")
        if stars_only(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        ways = edges.select(F.col("u").alias("n"), F.col("v").alias("m")).unionByName(
            edges.select(F.col("v").alias("n"), F.col("u").alias("m"))
        )
        low = ways.groupBy("n").agg(F.min("m").alias("least"))
        large = (
            ways.filter("m > n").join(low, "n").select(F.col("m").alias("u"), F.least("least", "n").alias("v"))
        )
        small = large.groupBy("u").agg(F.min("v").alias("w"))
        edges = (
            large.join(small, "u").select(F.col("v").alias("u"), F.col("w").alias("v")).filter("u <> v")
            .unionByName(small.select("u", F.col("w").alias("v")))
            .distinct()
        )


def stars_only(edges: DataFrame) -> bool:
    """Whether every u of the distinct edges (u, v) has one v, and no v is a u: then v names the component of u."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sides = ends.groupBy("n").agg(F.sum("up").alias("ups"), F.max("down").alias("down"))
    return not sides.filter("ups > 1 OR (ups = 1 AND down = 1)").agg(F.count(F.lit(1))).first()[0]


def groups_of(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys in sorted batches, one table each; holds one run and one batch at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns))
        at = 0
        for i in range(1, len(rows) + 1):
            if i < len(rows) and rows[i] == rows[at]:
                continue
            if held and rows[at] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(at, i - at))
            last = rows[at]
            if i < len(rows):
                yield pa.Table.from_batches(held)
                held = []
            at = i
    if held:
        yield pa.Table.from_batches(held)
