"""The pipeline, stage by stage, on the smallest tables, and the queries beside their SQL."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import corpus_pipeline  # noqa: E402
from llm import queries  # noqa: E402
from oracle import compare, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name, queries.QUERIES[name], queries.ORACLES[name]) is None


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = docs.limit(1).selectExpr("CAST(NULL AS long) AS doc_id", "CAST(NULL AS string) AS text", "lang", "CAST(NULL AS string) AS source", "n_chars")
    docs = docs.unionByName(extra)
    columns, before = docs.columns, docs.count()
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        if name != "sharding":
            assert docs.columns == columns
        if name in ("quality", "near_duplicates", "decontamination"):
            assert 0 < docs.count() <= before
        if name == "mixing":
            assert docs.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 2
        before = docs.count()
    assert docs.select("shard", "slot").distinct().count() == before


def test_run_on_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
