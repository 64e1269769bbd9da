"""From a folder of published files to lists, and all cuts of a replay against one at a time."""

import datetime as dt
import json
import os
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from peervane.operators.triage import ContractError, TooMuchQuarantinedError
from peervane.params import Resampling
from peervane.plans.ranking import rank
from peervane.plans.replay import CutKeys, rankings
from peervane.plans.run import run
from workload import backtests, from_files
from workload.base import REFERENCE, Tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
FEW = replace(backtests.SETTINGS, resampling=Resampling(draws=4, block=6, seed=20250101, periods=12))


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


def test_a_folder_becomes_a_document_and_a_quarantine(spark, tables):
    target = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    made = run(spark, from_files.publish(tables), FEW, REFERENCE, target)
    written = [json.loads(r[0]) for r in spark.read.text(f"{target}/document").collect()]
    assert written and {d["profile"] for d in written} <= {p.profile_id for p in FEW.profiles}
    listed = made.ranking.listed.filter("delivered").groupBy("profile").agg(F.collect_set("entity").alias("e"))
    assert {d["profile"]: {e["entity"] for e in d["top"]} for d in written if d["top"]} == {r["profile"]: set(r["e"]) for r in listed.collect()}
    reasons = {r[0] for r in spark.read.parquet(f"{target}/quarantine").select("reason").distinct().collect()}
    assert reasons <= {"key must have 14 digits", "price at or below zero"}
    # Every corrected line is gone: none of the stale prices is left.
    assert made.judged.filter("price = -1").count() == 0


def test_a_broken_folder_stops_before_ranking(spark, tables):
    folder = from_files.publish(tables)
    with pytest.raises(TooMuchQuarantinedError):
        run(spark, folder, FEW, REFERENCE, max_quarantined=-1.0)
    assert issubclass(ContractError, RuntimeError)


def test_all_cuts_at_once_equal_one_at_a_time(spark, tables):
    cuts = [dt.date(1999, 6, 30), dt.date(1999, 12, 31), dt.date(2000, 6, 30)]
    inputs = backtests.inputs(tables)
    listed, scored = rankings(inputs, FEW, cuts)
    columns = ["profile", "entity", "pick", "score", "appearance_rate", "delivered"]
    for cut in cuts:
        alone = rank(inputs, FEW, cut)
        got = listed.filter(F.col("cut_date") == F.lit(cut))
        assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, alone.listed.select(*columns).collect()))
        pool = ["profile", "entity", "score", "fee"]
        assert sorted(map(tuple, scored.filter(F.col("cut_date") == F.lit(cut)).select(*pool).collect())) == sorted(map(tuple, alone.scored.select(*pool).collect()))


@pytest.mark.parametrize("kind, values", [("bigint", [-5, 0, 7, 1 << 40]), ("string", ["", "a", "ab", "b"])])
def test_keys_of_entity_and_cut_keep_the_order_of_entities(spark, kind, values):
    frame = spark.createDataFrame([(v, c) for v in values for c in range(3)], f"e {kind}, c int")
    keys = CutKeys.of([dt.date(2000, 1, d) for d in (1, 2, 3)], frame.schema["e"].dataType)
    made = frame.withColumn("k", keys.joined(F.col("e"), F.col("c")))
    back = made.select("e", "c", keys.entity(F.col("k")).alias("e2"), keys.cut(F.col("k")).alias("c2")).collect()
    assert all((r["e"], r["c"]) == (r["e2"], r["c2"]) for r in back)
    for c in range(3):
        assert [r["e"] for r in made.filter(F.col("c") == c).orderBy("k").collect()] == values


def test_the_replay_scans_the_panel_once(spark, tables):
    from peervane.plans.replay import by_cut

    inputs = backtests.inputs(tables)
    keys = CutKeys.of(backtests.RULES.cut_dates, inputs.registry.schema["entity"].dataType)
    plan = by_cut(inputs, keys, 48).panel._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Generate explode" in plan
