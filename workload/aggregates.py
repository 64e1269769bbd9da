"""Grouped aggregates: summaries, metrics, distributions, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from peervane.operators import backtest as bt
from peervane.operators import series as sr
from peervane.operators.order_stats import quantiles, value_counts
from peervane.operators.peers import metric_dispersion
from peervane.operators.selection import manager_share
from peervane.operators.universe import count_by
from peervane.params import Backtest
from peervane.sources.documents import benchmark_by_group
from workload.base import (
    BENCHMARK_SQL,
    DAILY_SQL,
    SOUND_SQL,
    METRIC_CTES,
    PANEL_SQL,
    PERIODS,
    RATES_SQL,
    REFERENCE,
    REGISTRY_SQL,
    START,
    Tables,
    columns_r6,
    query,
    r6,
    with_clause,
)


@query(
    "agg1_series_summary", "AGG-1 ORD-1",
    with_clause(PANEL_SQL) + f"""SELECT entity, count(*) AS observations, min(ts) AS first_date, max(ts) AS last_date, {r6('arg_max(assets, ts)', 'assets')}, arg_max(holders, ts) AS holders
      FROM panel WHERE ts <= DATE '{REFERENCE}' GROUP BY entity""",
)
def _(t: Tables):
    return sr.summarise_series(t.panel, REFERENCE)


@query("agg4_count_by_category", "AGG-4", with_clause(REGISTRY_SQL) + "SELECT target_investor, count(*) AS n FROM registry GROUP BY 1")
def _(t: Tables):
    return count_by(t.registry, "target_investor")


@query(
    "agg5_manager_share", "AGG-5 ORD-3",
    f"""SELECT profile, manager, n, {r6('round_even(n / total::DOUBLE, 4)', 'share')} FROM (
      SELECT c_mktsegment AS profile, c_nationkey::VARCHAR AS manager, count(*) AS n, sum(count(*)) OVER (PARTITION BY c_mktsegment) AS total FROM customer GROUP BY 1, 2)
      QUALIFY row_number() OVER (PARTITION BY profile ORDER BY n DESC, manager) <= 5""",
)
def _(t: Tables):
    pool = t.customer.select(F.col("c_mktsegment").alias("profile"), F.col("c_nationkey").cast("string").alias("manager"))
    return manager_share(pool)


LONG_SQL = """long AS (SELECT l_returnflag AS profile, 'quantity' AS metric, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_returnflag, 'tax', l_tax FROM lineitem UNION ALL SELECT l_returnflag, 'late', CASE WHEN l_linenumber > 6 THEN 1.0 ELSE 0.0 END FROM lineitem)"""


def long_pool(t: Tables):
    return t.lineitem.select(
        F.col("l_returnflag").alias("profile"), F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("tax"),
        F.when(F.col("l_linenumber") > 6, 1.0).otherwise(0.0).alias("late"),
    )


@query(
    "agg7_dispersion", "AGG-7",
    with_clause(LONG_SQL) + f"""SELECT profile, metric, {r6('1 - max(n) / sum(n)::DOUBLE', 'dispersion')} FROM (
      SELECT profile, metric, value, count(*) AS n FROM long GROUP BY ALL) GROUP BY 1, 2""",
)
def _(t: Tables):
    return metric_dispersion(long_pool(t), ["quantity", "tax", "late"])


@query(
    "agg8_exact_quantiles", "AGG-8",
    f"""SELECT l_returnflag, {r6('quantile_cont(l_extendedprice, 0.01)', 'low')}, {r6('quantile_cont(l_extendedprice, 0.99)', 'high')}, {r6('quantile_cont(l_extendedprice, 0.25)', 'quarter')}
      FROM lineitem GROUP BY 1""",
)
def _(t: Tables):
    """Three flags hold a third of the lines each; their values are counted and sorted in ranges."""
    counts = value_counts(t.lineitem, ["l_returnflag"], "l_extendedprice")
    return quantiles(counts, ["l_returnflag"], "l_extendedprice", {"low": 0.01, "high": 0.99, "quarter": 0.25})


@query(
    "agg10_compounded_benchmark", "AGG-10 FLT-10",
    with_clause(RATES_SQL, BENCHMARK_SQL) + f"SELECT {r6('b', 'benchmark')} FROM bench",
)
def _(t: Tables):
    return sr.benchmark_over(t.rates, START, REFERENCE)


@query(
    "agg11_endpoint_returns", "AGG-11",
    with_clause(DAILY_SQL) + f"SELECT entity, {r6('arg_max(price, ts) / arg_min(price, ts) - 1', 'total_return')} FROM daily GROUP BY entity HAVING min(price) > 0",
)
def _(t: Tables):
    positive = t.daily.groupBy("entity").agg(F.min("price").alias("low")).filter("low > 0")
    kept = t.daily.join(positive, "entity", "left_semi")
    return kept.groupBy("entity").agg(sr.endpoint_return(F.col("price"), F.col("ts")).alias("total_return"))


METRIC_COLUMNS = (
    "total_return", "volatility", "max_drawdown", "negative_days", "downside_volatility", "average_assets", "flow_stability",
    "excess_return", "return_per_risk",
)


@query(
    "agg18_metric_panel", "AGG-10 AGG-11 AGG-12 AGG-13 AGG-14 AGG-15 AGG-16 AGG-17 AGG-18 WIN-1 WIN-3 SCL-18",
    with_clause(*METRIC_CTES) + f"SELECT entity, observations, first_date, last_date, {columns_r6(*METRIC_COLUMNS)} FROM metrics",
)
def _(t: Tables):
    return t.metrics


@query(
    "agg12_volatility_and_shares", "AGG-12 AGG-14 AGG-15",
    with_clause(PANEL_SQL, "r AS (SELECT entity, price / lag(price) OVER (PARTITION BY entity ORDER BY ts) - 1 AS ret FROM panel)") + f"""
    SELECT entity, {r6(f'stddev_samp(ret) * sqrt({PERIODS})', 'volatility')}, {r6('avg(CASE WHEN ret < 0 THEN 1.0 WHEN ret IS NOT NULL THEN 0.0 END::DOUBLE)', 'negative_days')},
      {r6(f'CASE WHEN count(*) FILTER (WHERE ret < -0.1) < 2 THEN 0 ELSE stddev_samp(CASE WHEN ret < -0.1 THEN ret END) * sqrt({PERIODS}) END', 'downside')} FROM r GROUP BY entity""",
)
def _(t: Tables):
    ret = F.col("ret")
    return sr.with_returns(t.panel).groupBy("entity").agg(
        sr.annualised_volatility(ret, PERIODS).alias("volatility"), sr.negative_share(ret).alias("negative_days"),
        sr.downside_volatility(ret, -0.1, PERIODS).alias("downside"),
    )


@query(
    "agg13_max_drawdown", "AGG-13",
    with_clause(DAILY_SQL, SOUND_SQL) + f"""SELECT entity, {r6('min(price / peak - 1)', 'max_drawdown')} FROM (
      SELECT *, max(price) OVER (PARTITION BY entity ORDER BY ts ROWS UNBOUNDED PRECEDING) AS peak FROM daily JOIN sound USING (entity)) GROUP BY entity""",
)
def _(t: Tables):
    peaks = sr.with_running_peak(t.sound_daily)
    return peaks.groupBy("entity").agg(sr.worst_drawdown(F.col("price"), F.col("peak")).alias("max_drawdown"))


@query(
    "agg16_flow_stability", "AGG-16 AGG-17",
    with_clause(PANEL_SQL) + f"SELECT entity, {r6('(coalesce(sum(inflow), 0) - coalesce(sum(outflow), 0)) / avg(assets)', 'flow_stability')}, {r6('avg(inflow)', 'average_inflow')} FROM panel GROUP BY entity",
)
def _(t: Tables):
    return t.panel.groupBy("entity").agg(
        sr.flow_stability(F.col("inflow"), F.col("outflow"), F.col("assets")).alias("flow_stability"),
        F.avg("inflow").alias("average_inflow"),
    )


CUTS = Backtest(cut_dates=(), end_date=REFERENCE)


@query(
    "agg22_discontinued", "AGG-22",
    """SELECT o_custkey AS entity, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders GROUP BY 1 HAVING CAST(max(o_orderdate) AS DATE) < DATE '2000-12-01'""",
)
def _(t: Tables):
    series = t.orders.select(F.col("o_custkey").alias("entity"), F.col("o_orderdate").cast("date").alias("ts"))
    return bt.discontinued(series, CUTS)


@query("agg23_medians", "AGG-23", f"SELECT l_shipmode_like AS kind, {r6('median(v)', 'median')} FROM (SELECT l_linestatus AS l_shipmode_like, l_extendedprice AS v FROM lineitem) GROUP BY 1")
def _(t: Tables):
    lines = t.lineitem.select(F.col("l_linestatus").alias("kind"), "l_extendedprice")
    return bt.medians(lines, "l_extendedprice", ["kind"])


@query(
    "agg24_share_below", "AGG-24",
    f"""SELECT c_mktsegment, {r6('avg(CASE WHEN c_acctbal < m THEN 1.0 ELSE 0.0 END::DOUBLE)', 'beaten')} FROM customer
      JOIN (SELECT c_mktsegment, avg(c_acctbal) AS m FROM customer GROUP BY 1) USING (c_mktsegment) GROUP BY 1""",
)
def _(t: Tables):
    values = t.customer.groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("m"))
    pool = t.customer.select("c_mktsegment", "c_acctbal")
    return bt.share_below(pool, values, ["c_mktsegment"], "c_acctbal", "m", "beaten")


@query(
    "agg27_latest_and_edges", "AGG-27",
    with_clause(*METRIC_CTES) + f"""SELECT max(last_date) AS latest, count(*) FILTER (WHERE excess_return > 0) AS above,
      {r6('min(excess_return)', 'lowest')}, {r6('max(excess_return)', 'highest')} FROM metrics""",
)
def _(t: Tables):
    return t.metrics.agg(
        F.max("last_date").alias("latest"), F.count_if(F.col("excess_return") > 0).alias("above"),
        F.min("excess_return").alias("lowest"), F.max("excess_return").alias("highest"),
    )


@query("agg28_benchmark_by_group", "AGG-28", with_clause(REGISTRY_SQL) + "SELECT DISTINCT grp, 'CDI' AS benchmark FROM registry WHERE coalesce(grp, '') <> ''")
def _(t: Tables):
    return benchmark_by_group(t.registry)


@query(
    "agg29_pivot_last_value", "AGG-29",
    f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {', '.join(r6(f"arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = '{s}')", s) for s in 'FOP')} FROM orders GROUP BY 1""",
)
def _(t: Tables):
    """Wide by a column of three known values: a pivot over entities stays long instead."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")
    return t.orders.groupBy(month).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.max_by("o_totalprice", "o_orderkey"))
