"""Registration of queries, and the tables they derive, in Spark and in SQL.

The test data holds no price panel, so one is derived: suppliers are entities,
months are dates, and a price is revenue over quantity.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peervane.functions.dates import window_start_date
from peervane.functions.numbers import log_size
from peervane.functions.tax import tax_efficiency
from peervane.operators.series import benchmark_over, metric_panel, sound_series
from peervane.params import Eligibility, Profile
from peervane.session import materialise

REFERENCE = dt.date(2000, 12, 31)
MONTHS = 48
START = window_start_date(REFERENCE, MONTHS)
PERIODS = 12
DIGITS = 6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


# Ties at the last kept digit are settled upwards, clear of floating-point noise.
TIE = 0.5003


def plain(frame: DataFrame) -> DataFrame:
    """Doubles cut to six digits and whole numbers widened, so that engines can be compared."""
    columns = []
    for f in frame.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.floor(c.cast("double") * 10.0**DIGITS + TIE) / F.lit(10.0**DIGITS)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        columns.append(c.alias(f.name))
    return frame.select(*columns)


def query(name: str, covers: str, sql: str | None = None):
    """Register a query over `Tables`; its SQL, if any, must name and round columns alike."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain(fn(Tables(spark, folder)))
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r6(expression: str, alias: str) -> str:
    return f"floor(({expression})::DOUBLE * {10**DIGITS} + {TIE}) / {10**DIGITS} + 0.0 AS {alias}"


def columns_r6(*names: str) -> str:
    return ", ".join(r6(n, n) for n in names)


class Tables:
    """The driver's tables and the ones derived from them, all lazy."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def panel(self) -> DataFrame:
        """Monthly panel of every supplier; only partial sums cross the shuffle."""
        month = F.trunc(F.col("l_shipdate").cast("date"), "month")
        paid = F.col("l_extendedprice")
        return self.lineitem.groupBy(F.col("l_suppkey").alias("entity"), month.alias("ts")).agg(
            (F.sum(paid) / F.sum("l_quantity")).alias("price"),
            F.sum(paid).alias("assets"),
            F.sum(F.when(F.col("l_returnflag") == "N", paid)).alias("inflow"),
            F.sum(F.when(F.col("l_returnflag") == "R", paid)).alias("outflow"),
            F.count(F.lit(1)).alias("holders"),
        )

    @cached_property
    def series(self) -> DataFrame:
        return self.panel.filter(F.col("ts").between(F.lit(START), F.lit(REFERENCE)))

    @cached_property
    def stored_series(self) -> DataFrame:
        """The windowed panel as a stored table, for plans that read it more than once."""
        return materialise(self.series, "series")

    @cached_property
    def daily(self) -> DataFrame:
        """Daily panel of the event users."""
        return self.events.groupBy(
            F.col("user_id").alias("entity"), F.col("ts").cast("date").alias("ts")
        ).agg(F.avg("value").alias("price"), F.sum("value").alias("assets"), F.count(F.lit(1)).alias("holders"))

    @cached_property
    def sound_daily(self) -> DataFrame:
        """The daily panel without entities that have an unusable price or a single day."""
        return self.daily.join(sound_series(self.daily), "entity", "left_semi")

    @cached_property
    def rates(self) -> DataFrame:
        """Month-on-month return of the whole market; the window holds a row per month."""
        month = F.trunc(F.col("l_shipdate").cast("date"), "month")
        market = self.lineitem.groupBy(month.alias("ts")).agg(
            (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("price")
        )
        rate = F.col("price") / F.lag("price").over(W.orderBy("ts")) - 1
        return market.select("ts", rate.alias("rate")).filter("rate IS NOT NULL")

    @cached_property
    def registry(self) -> DataFrame:
        """Suppliers with nation as peer group and region as manager."""
        balance = F.col("s_acctbal")
        return (
            self.supplier.join(self.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"),
                F.col("n_name").alias("grp"), F.col("r_name").alias("manager"),
                F.when(balance < 0, "Multimercado").otherwise("Renda Fixa Simples").alias("classification"),
                F.when(balance > 9500, "Cancelada").otherwise("Em Funcionamento Normal").alias("status"),
                F.when(F.col("n_name") == "NATION_7", "Fechado").otherwise("Aberto").alias("condominium"),
                F.when(balance.between(9000, 9200), "S").otherwise("N").alias("exclusive"),
                F.when(F.col("r_name") == "ASIA", "Qualificado").otherwise("Público Geral").alias("target_investor"),
                F.when(balance > 5000, "S").otherwise("N").alias("long_term"),
                F.when(balance.between(200, 400), "S").otherwise("N").alias("holds_funds"),
                F.date_sub(F.lit(REFERENCE), F.floor(F.abs(balance)).cast("int")).alias("constituted"),
            )
        )

    def filings(self, status: str | None = None) -> DataFrame:
        """Monthly terms of each supplier, of all lines or of one line status."""
        month = F.trunc(F.col("l_shipdate").cast("date"), "month")
        lines = self.lineitem if status is None else self.lineitem.filter(F.col("l_linestatus") == status)
        return (
            lines.groupBy(F.col("l_suppkey").alias("entity"), month.alias("ts"))
            .agg(
                F.round(F.avg("l_tax") / 4, 9).alias("fee"),
                F.floor(F.avg("l_quantity")).cast("bigint").alias("redemption_days"),
                F.min("l_extendedprice").alias("minimum_investment"),
            )
        )

    @cached_property
    def terms(self) -> DataFrame:
        """One set of terms per supplier over the whole table."""
        return self.lineitem.groupBy(F.col("l_suppkey").alias("entity")).agg(
            F.round(F.avg("l_tax") / 4, 9).alias("fee"),
            F.floor(F.avg("l_quantity")).cast("bigint").alias("redemption_days"),
            F.min("l_extendedprice").alias("minimum_investment"),
        )

    @cached_property
    def holdings(self) -> DataFrame:
        """Each supplier holds the first and the last supplier of its nation."""
        ends = self.supplier.groupBy("s_nationkey").agg(
            F.min("s_suppkey").alias("first"), F.max("s_suppkey").alias("last")
        )
        weight = F.abs("s_acctbal")
        return (
            self.supplier.join(ends, "s_nationkey")
            .select(
                F.col("s_suppkey").alias("src"),
                F.inline(
                    F.array(
                        F.struct(F.col("first").alias("dst"), weight.alias("value")),
                        F.struct(F.col("last").alias("dst"), F.lit(100.0).alias("value")),
                    )
                ),
            )
            .filter("src <> dst")
        )

    @cached_property
    def benchmark(self):
        return benchmark_over(self.rates, START, REFERENCE).scalar()

    @cached_property
    def metrics(self) -> DataFrame:
        return metric_panel(self.series, self.benchmark, periods=PERIODS)

    @cached_property
    def funds(self) -> DataFrame:
        """Registry, terms and metrics, rounded so that ties mean the same everywhere."""
        measured = self.metrics.withColumns(
            {
                m: F.round(m, 9)
                for m in (
                    "excess_return", "return_per_risk", "volatility", "max_drawdown", "negative_days", "flow_stability",
                )
            }
        ).withColumn("size", F.round(log_size(F.col("average_assets")), 9))
        return (
            self.registry.join(self.terms, "entity")
            .join(measured, "entity")
            .withColumn("tax_efficiency", tax_efficiency(F.col("name"), F.col("grp"), F.lit("N")))
        )

    @cached_property
    def stored_funds(self) -> DataFrame:
        return materialise(self.funds, "funds")


LIQUIDITY = Profile(
    "liquidity",
    {"volatility": 28, "max_drawdown": 22, "flow_stability": 12, "excess_return": 12, "size": 12,
     "redemption_days": 8, "tax_efficiency": 6},
    {"volatility": 5, "max_drawdown": 3, "flow_stability": 3, "excess_return": 3, "size": 3,
     "redemption_days": 3, "tax_efficiency": 2},
    Eligibility(["Público Geral"], 5_000.0, 25),
)
HORIZON = Profile(
    "horizon",
    {"return_per_risk": 28, "max_drawdown": 20, "excess_return": 18, "negative_days": 12, "size": 12,
     "tax_efficiency": 6, "redemption_days": 4},
    {"return_per_risk": 5, "max_drawdown": 3, "excess_return": 5, "negative_days": 3, "size": 3,
     "tax_efficiency": 2, "redemption_days": 3},
    Eligibility(["Público Geral", "Qualificado"], 50_000.0, 30),
)
PROFILES = (LIQUIDITY, HORIZON)


def with_clause(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


PANEL_SQL = """panel AS (
  SELECT l_suppkey AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS ts,
    sum(l_extendedprice) / sum(l_quantity) AS price, sum(l_extendedprice) AS assets,
    sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END) AS inflow,
    sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS outflow, count(*) AS holders
  FROM lineitem GROUP BY 1, 2)"""
SERIES_SQL = f"""series AS (
  SELECT * FROM panel WHERE ts BETWEEN DATE '{START}' AND DATE '{REFERENCE}')"""
SOUND_SQL = """sound AS (SELECT entity FROM daily GROUP BY 1
    HAVING count(*) >= 2 AND count(*) FILTER (WHERE price IS NULL OR price <= 0) = 0)"""

DAILY_SQL = """daily AS (
  SELECT user_id AS entity, CAST(ts AS DATE) AS ts, avg(value) AS price, sum(value) AS assets, count(*) AS holders
  FROM events GROUP BY 1, 2)"""
RATES_SQL = """market AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ts, sum(l_extendedprice) / sum(l_quantity) AS price
  FROM lineitem GROUP BY 1),
rates AS (SELECT * FROM (SELECT ts, price / lag(price) OVER (ORDER BY ts) - 1 AS rate FROM market) WHERE rate IS NOT NULL)"""
BENCHMARK_SQL = f"""bench AS (
  SELECT coalesce(product(1 + rate), 1) - 1 AS b FROM rates WHERE ts BETWEEN DATE '{START}' AND DATE '{REFERENCE}')"""
REGISTRY_SQL = f"""registry AS (
  SELECT s_suppkey AS entity, s_name AS name, n_name AS grp, r_name AS manager,
    CASE WHEN s_acctbal < 0 THEN 'Multimercado' ELSE 'Renda Fixa Simples' END AS classification,
    CASE WHEN s_acctbal > 9500 THEN 'Cancelada' ELSE 'Em Funcionamento Normal' END AS status,
    CASE WHEN n_name = 'NATION_7' THEN 'Fechado' ELSE 'Aberto' END AS condominium,
    CASE WHEN s_acctbal BETWEEN 9000 AND 9200 THEN 'S' ELSE 'N' END AS exclusive,
    CASE WHEN r_name = 'ASIA' THEN 'Qualificado' ELSE 'Público Geral' END AS target_investor,
    CASE WHEN s_acctbal > 5000 THEN 'S' ELSE 'N' END AS long_term,
    CASE WHEN s_acctbal BETWEEN 200 AND 400 THEN 'S' ELSE 'N' END AS holds_funds,
    DATE '{REFERENCE}' - CAST(floor(abs(s_acctbal)) AS INTEGER) AS constituted
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
TERMS_SQL = """terms AS (
  SELECT l_suppkey AS entity, round(avg(l_tax) / 4, 9) AS fee, CAST(floor(avg(l_quantity)) AS BIGINT) AS redemption_days,
    min(l_extendedprice) AS minimum_investment
  FROM lineitem GROUP BY 1)"""
HOLDINGS_SQL = """ends AS (
  SELECT s_nationkey, min(s_suppkey) AS first_key, max(s_suppkey) AS last_key FROM supplier GROUP BY 1),
holdings AS (
  SELECT s_suppkey AS src, first_key AS dst, abs(s_acctbal) AS value FROM supplier JOIN ends USING (s_nationkey) WHERE s_suppkey <> first_key
  UNION ALL
  SELECT s_suppkey, last_key, 100.0 FROM supplier JOIN ends USING (s_nationkey) WHERE s_suppkey <> last_key)"""


def filings_sql(name: str, status: str | None = None) -> str:
    kept = "" if status is None else f" WHERE l_linestatus = '{status}'"
    return f"""{name} AS (
  SELECT l_suppkey AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS ts, round(avg(l_tax) / 4, 9) AS fee,
    CAST(floor(avg(l_quantity)) AS BIGINT) AS redemption_days, min(l_extendedprice) AS minimum_investment
  FROM lineitem{kept} GROUP BY 1, 2)"""


METRICS_SQL = f"""moves AS (
  SELECT *, price / lag(price) OVER w - 1 AS ret, max(price) OVER (w ROWS UNBOUNDED PRECEDING) AS peak
  FROM series WINDOW w AS (PARTITION BY entity ORDER BY ts)),
metrics0 AS (
  SELECT entity, count(*) AS observations, min(ts) AS first_date, max(ts) AS last_date,
    arg_max(price, ts) / arg_min(price, ts) - 1 AS total_return,
    stddev_samp(ret) * sqrt({PERIODS}) AS volatility, min(price / peak - 1) AS max_drawdown,
    avg(CASE WHEN ret < 0 THEN 1.0 WHEN ret IS NOT NULL THEN 0.0 END::DOUBLE) AS negative_days,
    CASE WHEN count(*) FILTER (WHERE ret < 0) < 2 THEN 0
      ELSE stddev_samp(CASE WHEN ret < 0 THEN ret END) * sqrt({PERIODS}) END AS downside_volatility,
    avg(assets) AS average_assets,
    (coalesce(sum(inflow), 0) - coalesce(sum(outflow), 0)) / avg(assets) AS flow_stability
  FROM moves GROUP BY entity HAVING count(*) >= 2 AND min(price) > 0),
metrics AS (
  SELECT *, total_return - b AS excess_return,
    CASE WHEN volatility > 0 THEN (total_return - b) / volatility END AS return_per_risk
  FROM metrics0, bench)"""
FUNDS_SQL = """funds AS (
  SELECT r.*, t.* EXCLUDE (entity), 0.0::DOUBLE AS tax_efficiency,
    round(ln(1 + average_assets), 9) AS size, round(m.excess_return, 9) AS excess_return,
    round(m.return_per_risk, 9) AS return_per_risk, round(m.volatility, 9) AS volatility,
    round(m.max_drawdown, 9) AS max_drawdown, round(m.negative_days, 9) AS negative_days,
    round(m.flow_stability, 9) AS flow_stability,
    m.observations, m.first_date, m.last_date, m.total_return, m.average_assets
  FROM registry r JOIN terms t USING (entity) JOIN metrics m USING (entity))"""

METRIC_CTES = (PANEL_SQL, SERIES_SQL, RATES_SQL, BENCHMARK_SQL, METRICS_SQL)
FUND_CTES = (*METRIC_CTES, REGISTRY_SQL, TERMS_SQL, FUNDS_SQL)


def pools_sql() -> str:
    parts = []
    for p in PROFILES:
        e = p.eligibility
        investors = ", ".join(f"'{i}'" for i in e.target_investor)
        parts.append(
            f"SELECT '{p.profile_id}' AS profile, * FROM funds WHERE target_investor IN ({investors})"
            f" AND (minimum_investment IS NULL OR minimum_investment <= {e.max_minimum_investment})"
            f" AND redemption_days <= {e.max_redemption_days}"
        )
    return "pools AS (\n  " + "\n  UNION ALL\n  ".join(parts) + ")"


def weights_sql(name: str = "declared") -> str:
    rows = [
        f"('{p.profile_id}', '{m}', {i}, {w}, {p.jitter.get(m, 0)})"
        for p in PROFILES
        for i, (m, w) in enumerate(p.weights.items())
    ]
    return f"{name} (profile, metric, ord, weight, jitter) AS (VALUES {', '.join(rows)})"


def hashed_sql(source: str, seed: int, draw: str, code: str, position: str) -> str:
    """The rows of `source` with `u`, the uniform of (seed, draw, code, position)."""
    from peervane.functions.uniform import ADDED, DRAW_STEP, HALF, MIX, MODULUS, POSITION_STEP

    m = MODULUS
    return f"""(SELECT * EXCLUDE (h1, h2, h3, h4, high), ((h4 * {MIX} % {m}) * (h4 * {MIX} % {m}) + {ADDED[2]}) % {m} / {float(m)}::DOUBLE AS u FROM (
      SELECT *, (h3 * h3 + {ADDED[1]}) % {m} AS h4 FROM (
        SELECT *, ((h1 * h1 + {ADDED[0]} + high) % {m}) AS h2, (((h1 * h1 + {ADDED[0]} + high) % {m}) * {MIX} + ({position})::BIGINT * {POSITION_STEP}) % {m} AS h3 FROM (
          SELECT *, ((({draw})::BIGINT * {DRAW_STEP} + {seed}) % {m} + ({code})::BIGINT % {1 << HALF}) % {m} AS h1, ({code})::BIGINT // {1 << HALF} AS high FROM {source}))))"""


def code_sql(key: str) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 15))::BIGINT"
