"""Shapes of physical plans, and results that must not depend on partitioning."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from peervane.operators.dedup import last_per_key
from peervane.operators.resample import aligned_returns, resample_metrics
from peervane.operators.selection import top_per_group
from peervane.operators.series import metric_panel
from peervane.params import Resampling
from peervane.session import materialise

DAY = dt.date(2025, 1, 1)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(1)
    rows = [(f"e{e}", DAY + dt.timedelta(d), 100 * (1 + rng.random()), 5.0, 1.0, 2.0, 3, "unused") for e in range(20) for d in range(50)]
    return materialise(
        spark.createDataFrame(rows, "entity string, ts date, price double, assets double, inflow double, outflow double, holders bigint, note string"), "panel"
    )


def test_metric_panel_shuffles_once_and_prunes(panel):
    plan = plan_of(metric_panel(panel, F.lit(0.1), reference=DAY + dt.timedelta(40)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan
    assert "note" not in plan.split("ReadSchema")[1] and "PushedFilters: [IsNotNull(ts), LessThanOrEqual(ts" in plan


def test_hot_keys_are_limited_before_the_shuffle(panel):
    for frame in (last_per_key(panel, ["entity"], [F.col("ts")]), top_per_group(panel, ["entity"], [F.desc("price")], 5)):
        plan = plan_of(frame)
        assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_draws_do_not_depend_on_partitioning(spark, panel):
    rates = spark.createDataFrame([(DAY + dt.timedelta(d), 0.0001) for d in range(50)], "ts date, rate double")
    settings = Resampling(draws=30, block=7, seed=9)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for partitions in ("3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            drawn = resample_metrics(aligned_returns(panel, rates), settings)
            results.append(sorted(map(tuple, drawn.collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] and len(results[0]) == 600
