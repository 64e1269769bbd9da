"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def build_session(app: str = "peervane", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, use the one it gives."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # Building an expression is one call into the JVM, without a stack trace each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Where the cluster names none, a temporary folder is taken, but only in
    local mode: a machine-local path is lost with its machine.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/{app}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables stored within it are deleted at its end, except those stored with `keep`: the result must be one of these."""
    paths: list[str] = []
    before = PASSING.set(paths)
    try:
        yield
    finally:
        PASSING.reset(before)
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts lineage in a way that survives lost executors, and it fixes the
    values: every later branch sees the same rows bit for bit, which plans that
    read a table twice (ranks from counts, tiles from projections) rely on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if not keep and (passing := PASSING.get()) is not None:
        passing.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def wide_parallelism(spark: SparkSession) -> int:
    """Tasks for heavy work on few bytes, which AQE would otherwise coalesce away."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
