"""Sharding by a two-pass external shuffle.

Pass one scatters records uniformly into buckets that fit in memory: a seeded hash of the record's id and its place in
the input names the bucket, whatever its text, so copies and repeated ids spread like other rows. Pass two
permutes each bucket with `shuffle`, Spark's Fisher-Yates over an array. Buckets one after the other are a random
order of all records, and equal cuts of it are the shards: the law is `rows`, counts differ by one at most.

The scattered table is stored before the second pass, buckets are dealt to a fixed number of partitions and each
is ordered before it is permuted, so a task that runs again repeats its result. Only counts per bucket are summed in one place.

Defined results: a null or empty text has 8 bytes and checksum 0; null ids and repeated rows are records like others;
an empty table gives no rows. Columns that are carried along stand in a struct and cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.tables import materialise

OVERHEAD = 8  # bytes of a record beside its text
BUCKETS_IN_TASK = 8  # at most: a task permutes them one after the other


def sharded(
    docs: DataFrame, shards: int = 24, bucket_bytes: int = 16 << 20, seed: int = 11, keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, *keep) for every row of (doc_id, text).

    A bucket holds about `bucket_bytes` of what is carried along: the digest, and the columns in `keep`.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = F.struct(*keep) if keep else F.lit(None).cast("struct<none:int>")
    records = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), kept.alias("kept"),
        F.monotonically_increasing_id().alias("record"),
    )
    records = materialise(records, "shard-records")
    carried = F.lit(64) if not keep else F.lit(64) + F.col("size")
    total = records.agg(F.count(F.lit(1)).alias("n"), F.sum(carried).alias("bytes")).first()
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, parallel, -(-(total["bytes"] or 0) // bucket_bytes))
    named = records.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "record", F.lit(seed)), F.lit(buckets)))
    counts = named.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("bucket", before.alias("start"))
    entry = F.struct("record", "doc_id", "size", "text_crc32", "kept")
    gathered = (
        named.repartition(max(parallel, -(-buckets // BUCKETS_IN_TASK)), "bucket").groupBy("bucket")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .sortWithinPartitions("bucket")
    )
    permuted = gathered.select("bucket", F.posexplode(F.shuffle("entries", seed)).alias("pos", "e"))
    n = total["n"]
    at = F.col("start") + F.col("pos")
    # Shard s holds the places from ceil(s * n / shards) on.
    shard = F.expr(f"(start + pos) * {shards} div {max(n, 1)}")
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return (
        permuted.join(starts, "bucket")
        .withColumn("shard", shard)
        .select(
            "e.doc_id", "e.size", "e.text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
            (at - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
            *(F.col(f"e.kept.{c}").alias(c) for c in keep),
        )
    )


def placed_records(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): whole records go through both passes, and what arrives is measured."""
    placed = sharded(docs.select("doc_id", F.col("text").cast("string").alias("text")), keep=["text"], **options)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id", (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        "law", "shard", "slot", "grown_shard",
    )


def write_shards(docs: DataFrame, path: str, columns: Sequence[str] = ("doc_id", "text"), **options) -> None:
    """Write the shards as folders shard=0, shard=1, ...; a shard is as many files as it needs, which follow its slots in order."""
    carried = docs.select(*(F.col(c).alias(f"carried_{c}") for c in columns), "doc_id", "text")
    placed = sharded(carried, keep=[f"carried_{c}" for c in columns], **options)
    out = placed.select(*(F.col(f"carried_{c}").alias(c) for c in columns), "slot", "shard")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
