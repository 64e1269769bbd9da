"""Raw delimited and JSON text, read as strings and cast explicitly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peervane.operators.dedup import last_per_key

# Where a row stood in its file: later rows correct earlier ones.
ORIGIN = ("src_file", "src_block", "src_row")


def read_releases(
    spark: SparkSession, path: str | Sequence[str], separator: str = ";", with_origin: bool = False
) -> list[DataFrame]:
    """Latin-1 text with a header, quoting off, every column a string: a frame per header that occurs.

    One record per line, so files split across tasks. Free text may hold stray
    quotes; extra fields are dropped and missing ones become null. Every path is
    asked for its header, and paths of equal headers are read together. A file
    within one path whose header differs from the others fails the read.
    """
    reader = (
        spark.read.option("sep", separator)
        .option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("quote", "")
        .option("escape", "")
        .option("inferSchema", False)
        .option("enforceSchema", False)
    )
    paths = [path] if isinstance(path, str) else list(path)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for one in paths:
        by_header.setdefault(tuple(reader.csv(one).columns), []).append(one)
    frames = [reader.csv(same) for same in by_header.values()]
    if not with_origin:
        return frames
    return [
        frame.select(
            "*",
            F.col("_metadata.file_path").alias("src_file"),
            F.col("_metadata.file_block_start").alias("src_block"),
            F.monotonically_increasing_id().alias("src_row"),
        )
        for frame in frames
    ]


def read_delimited(
    spark: SparkSession, path: str | Sequence[str], separator: str = ";", with_origin: bool = False
) -> DataFrame:
    """All releases as one table, matched by column name; what a release lacks is null."""
    return union_drifting(read_releases(spark, path, separator, with_origin))


def select_and_rename(frame: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns that arrived, under their new names."""
    kept = [F.col(raw).alias(name) for raw, name in mapping.items() if raw in frame.columns]
    return frame.select(*kept, *[c for c in ORIGIN if c in frame.columns])


def cast_present(frame: DataFrame, casts: Mapping[str, Column]) -> DataFrame:
    """Apply only the casts whose column arrived."""
    return frame.withColumns({c: e for c, e in casts.items() if c in frame.columns})


def keep_last_in_file(frame: DataFrame, key: str) -> DataFrame:
    """One row per key, the last in file order; the origin columns are spent here."""
    if key in frame.columns:
        frame = last_per_key(frame, [key], [F.col(c) for c in ORIGIN])
    return frame.drop(*ORIGIN)


def union_drifting(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of releases whose columns differ; what a release lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_json_array(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """A file holding one JSON array of objects, every field a string."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return spark.read.schema(schema).option("multiLine", True).json(path)
