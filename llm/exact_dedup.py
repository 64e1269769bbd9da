"""Exact deduplication by a 128-bit content hash, confirmed byte by byte.

Texts are equal when they are identical after every run of ASCII white space
became one space. Rows are grouped by the MD5 of that text, with counts and
smallest ids summed before the shuffle; texts never travel for this. Only rows whose hash
occurs more than once meet their group's first text again, and are compared with it byte by
byte. A row that differs in spite of an equal hash is grouped by its text instead.

The join on the hash has the wide table on one side, so a hash that holds a third of all rows is split by
adaptive execution; no task holds a group.

Defined results: a null text counts as empty, and all empty texts are one group. A null id
never wins over another id; a group of null ids alone has a null `keep_id`. Rows that repeat both id and text are counted
in `group_size`, and all of them carry the same `kept`. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import materialise

BLANKS = "[\\x20\\x09-\\x0D]+"


def normalised(text) -> F.Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for every row of (doc_id, text)."""
    # One pass over the texts keeps ids and hashes only.
    body = F.encode("plain", "UTF-8")
    prints = materialise(
        docs.select("doc_id", normalised(F.col("text")).alias("plain")).select(
            "doc_id", F.unhex(F.md5(body)).alias("hash"), F.unhex(F.sha2(body, 256)).alias("sha")
        ),
        "prints",
    )
    counts = prints.groupBy("hash").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    repeated = materialise(counts.filter("n > 1"), "repeated-hashes")
    texts = docs.select("doc_id", normalised(F.col("text")).alias("plain")).withColumn(
        "hash", F.unhex(F.md5(F.encode("plain", "UTF-8")))
    )
    # Sorted joins at every size, each between stored tables, so that a hash with very many rows can be split.
    members = materialise(texts.join(repeated.hint("merge"), "hash"), "hash-members")
    # One text of each group: the smallest among rows with the smallest id.
    first = materialise(members.filter("doc_id <=> first_id").groupBy("hash").agg(F.min("plain").alias("first_plain")), "first-texts")
    strays = members.join(first.hint("merge"), "hash").filter("plain <> first_plain").select("doc_id", "hash", "plain")
    strays = materialise(strays, "hash-collisions")
    apart = strays.groupBy("hash", "plain").agg(F.min("doc_id").alias("stray_id"), F.count(F.lit(1)).alias("stray_n"))
    # The SHA-256 of a stray tells its rows from the others of the same MD5.
    apart = apart.select(
        "hash", F.unhex(F.sha2(F.encode("plain", "UTF-8"), 256)).alias("sha"), "stray_id", "stray_n"
    )
    moved = apart.groupBy("hash").agg(F.sum("stray_n").alias("moved"))
    sizes = repeated.join(moved, "hash", "left").select("hash", "first_id", (F.col("n") - F.coalesce("moved", F.lit(0))).alias("n"))
    joined = prints.join(sizes, "hash", "left").join(apart, ["hash", "sha"], "left")
    keep = F.when(F.col("stray_n").isNotNull(), F.col("stray_id")).when(F.col("n").isNotNull(), F.col("first_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("stray_n", "n", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
