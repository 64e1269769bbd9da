"""Daily reports staged as they arrive in a folder.

A file source hands over new files once. Each micro-batch is triaged against the reference date as a whole: the last line of every entity and
day stays, later days are set aside, and the rest is clean or rejected with a reason. Every fate has a folder of its own, by batch, so a batch that is
run again replaces itself. A row that is restated arrives in a later batch; `newest_rows` takes the last of each entity and day, and a day whose last
line was rejected has no row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from peervane.functions.dates import iso_date
from peervane.functions.keys import digits_only
from peervane.functions.numbers import to_double, to_long
from peervane.operators.dedup import last_per_key
from peervane.operators.triage import CLEAN, FUTURE, QUARANTINED, accounting, rejection_reason, triage
from peervane.sources.filings import DAILY_REPORT, without_subclasses
from peervane.sources.text import ORIGIN

AMOUNTS = ("portfolio_value", "price", "assets", "inflow", "outflow")
FOLDERS = {CLEAN: "clean", QUARANTINED: "quarantine", FUTURE: "future"}


def stream_daily_reports(
    spark: SparkSession, folder: str, header: list[str], files_per_batch: int | None = None
) -> DataFrame:
    """Typed rows of every file that lands in the folder, with their origin; `header` is its column order."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = (
        spark.readStream.schema(schema)
        .option("sep", ";")
        .option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("quote", "")
        .option("enforceSchema", False)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    origin = [F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.file_block_start").alias("src_block")]
    named = reader.csv(folder).select(*[F.col(r).alias(n) for r, n in DAILY_REPORT.items() if r in header], *origin)
    return without_subclasses(named).withColumns(
        {
            "entity": digits_only(F.col("entity")),
            "ts": iso_date(F.col("ts")),
            "holders": to_long(F.col("holders")),
            **{c: to_double(F.col(c)) for c in AMOUNTS if c in named.columns},
        }
    )


def stage_stream(rows: DataFrame, target: str, checkpoint: str, reference: dt.date) -> StreamingQuery:
    """Triage and append each micro-batch under its own number; the batch is read once."""

    def write(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn("src_row", F.monotonically_increasing_id())
        reason = rejection_reason(F.col("entity"), F.col("ts"), F.col("price"), F.col("assets"))
        judged = triage(numbered, ["entity", "ts"], "ts", reason, reference, [F.col(c) for c in ORIGIN]).drop(*ORIGIN)
        path = f"{target}/judged/batch={number}"
        judged.write.mode("overwrite").parquet(path)
        stored = batch.sparkSession.read.schema(judged.schema).parquet(path)
        for fate, folder in FOLDERS.items():
            part = {CLEAN: F.date_format("ts", "yyyyMM"), QUARANTINED: F.col("reason"), FUTURE: F.date_format("ts", "yyyyMM")}[fate]
            name = "reason" if fate == QUARANTINED else "month"
            mine = stored.filter(F.col("disposition") == fate).withColumn(name, part)
            kept = mine.drop("disposition", "copies", *([] if fate == QUARANTINED else ["reason"]))
            kept.write.mode("overwrite").partitionBy(name).parquet(f"{target}/{folder}/batch={number}")
        accounting(stored).coalesce(1).write.mode("overwrite").parquet(f"{target}/accounting/batch={number}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_rows(spark: SparkSession, target: str) -> DataFrame:
    """The clean rows in force after all batches: a later batch replaces what an earlier one said of an entity and day."""
    judged = spark.read.option("basePath", f"{target}/judged").parquet(f"{target}/judged")
    last = last_per_key(judged, ["entity", "ts"], [F.col("batch")])
    return last.filter(F.col("disposition") == CLEAN).drop("disposition", "reason", "copies", "batch")
