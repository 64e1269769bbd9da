"""Staged Parquet tables, provenance of inputs, and the quarantine."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peervane.functions.dates import months_touched

HASH_DIGITS = 16


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system the path belongs to, local or shared."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def whole_path(spark: SparkSession, path: str) -> str:
    """The path with its scheme and root, as file listings name it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def read_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Many Parquet parts as one table; filters and columns still reach the scan."""
    return spark.read.parquet(*paths)


def read_months(spark: SparkSession, path: str, start: dt.date, end: dt.date) -> DataFrame:
    """The staged months a window touches; other partitions are not listed for reading."""
    return read_parts(spark, [path]).filter(F.col("month").isin(months_touched(start, end)))


def empty_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(
    spark: SparkSession, path: str, reader: Callable[[SparkSession, str], DataFrame], schema: T.StructType | str
) -> DataFrame:
    """An optional input: read where present, else an empty table of its schema."""
    return reader(spark, path) if path_exists(spark, path) else empty_table(spark, schema)


def fingerprints(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(name, sha256, size_bytes, modified): content hashes taken by the tasks, a file each."""
    files = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.sha2("content", 256).alias("sha256"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
        "path",
    )


def changed_inputs(before: DataFrame, now: DataFrame) -> DataFrame:
    """(name, state): added, removed, changed or same. Size first, then content."""
    old = before.select("name", F.col("sha256").alias("_h0"), F.col("size_bytes").alias("_s0"))
    new = now.select("name", F.col("sha256").alias("_h1"), F.col("size_bytes").alias("_s1"))
    state = (
        F.when(F.col("_h0").isNull(), "added")
        .when(F.col("_h1").isNull(), "removed")
        .when((F.col("_s0") != F.col("_s1")) | (F.col("_h0") != F.col("_h1")), "changed")
        .otherwise("same")
    )
    return old.join(new, "name", "full").select("name", state.alias("state"))


def stage_daily(
    spark: SparkSession, paths: Mapping[str, str], target: str,
    reader: Callable[[SparkSession, str], DataFrame],
) -> list[str]:
    """Parse each distinct content once into `target`, partitioned by (month, src_sha).

    `paths` maps a month to its file. A restated file has another hash, so it is
    parsed again into its own partition; `current_rows` then picks the newest.
    Returns the months written. A retried write replaces its own partition only.
    """
    if not paths:
        return []
    listed = {row["path"]: row["sha256"] for row in fingerprints(spark, list(paths.values())).select("path", "sha256").collect()}
    written = []
    for month, path in paths.items():
        sha = listed[whole_path(spark, path)][:HASH_DIGITS]
        part = f"{target.rstrip('/')}/month={month}/src_sha={sha}"
        if path_exists(spark, part + "/_SUCCESS"):
            continue
        reader(spark, path).write.mode("overwrite").parquet(part)
        written.append(month)
    return written


def current_rows(staged: DataFrame, manifest: DataFrame) -> DataFrame:
    """Staged rows whose content is the one the manifest names, a semi join on the hash."""
    named = manifest.select(F.substring("sha256", 1, HASH_DIGITS).alias("src_sha"))
    return staged.join(named, "src_sha", "left_semi")


def write_quarantine(quarantined: DataFrame, target: str) -> None:
    """Rejected rows by reason; a reason's rows are spread, not gathered in one task."""
    quarantined.write.mode("overwrite").partitionBy("reason").parquet(target)
