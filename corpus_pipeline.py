"""A corpus in five stages: quality, near duplicates, decontamination, mixing, shards.

Every stage works on all rows its predecessor kept and returns the columns of documents; the last returns
where each record goes. A text that the mix takes twice is two rows from then on. Nulls, empty texts and
empty tables pass through the stages as the operators define.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import decontaminate, mixing, ngram_join, quality, sharding
from llm.tables import materialise, passing_tables, shuffles_released, table

#: SQL can express neither the classifier nor the shuffle.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id; rows without id stay."""
    # Only the ids that go outlast the join; its tables and shuffles are larger than the documents.
    with passing_tables(spark), shuffles_released(spark):
        found = ngram_join.jaccard_components(docs, k=5, num=8, den=10)
        others = materialise(found.filter("component_id <> doc_id").select("doc_id").distinct(), "near-copies", keep=True)
    return docs.join(others.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item, edited or not."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    taken = mixing.mixed(docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("row")), keep=["row"])
    return taken.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each record goes, measured on the records that arrive there."""
    return sharding.placed_records(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", without_test_items),
    ("mixing", mixed_sources),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
