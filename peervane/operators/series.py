"""Per-entity time series: returns, peaks, flags, and the metric panel.

Every operator expects one row per (entity, date), which `triage` guarantees.
A date column therefore bounds a series by the calendar: no entity, however
much raw data it has, brings more than 366 rows a year into a window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peervane.functions import numbers

PERIODS_PER_YEAR = 252


@dataclass(frozen=True)
class PanelColumns:
    """Names of the columns of a price panel."""

    entity: str = "entity"
    ts: str = "ts"
    price: str = "price"
    assets: str = "assets"
    inflow: str = "inflow"
    outflow: str = "outflow"
    holders: str = "holders"


PANEL = PanelColumns()


def require_dates(panel: DataFrame, ts: str) -> None:
    """A calendar date bounds a series; a timestamp would not."""
    if not isinstance(panel.schema[ts].dataType, T.DateType):
        raise TypeError(f"{ts} must be a date: it bounds the rows of one entity")


def _ordered(cols: PanelColumns) -> W:
    return W.partitionBy(cols.entity).orderBy(cols.ts)


def with_returns(panel: DataFrame, cols: PanelColumns = PANEL, name: str = "ret") -> DataFrame:
    """Simple return over consecutive observations; null on the first."""
    require_dates(panel, cols.ts)
    before = F.lag(cols.price).over(_ordered(cols))
    return panel.withColumn(name, F.try_divide(F.col(cols.price), before) - 1)


def with_running_peak(panel: DataFrame, cols: PanelColumns = PANEL, name: str = "peak") -> DataFrame:
    require_dates(panel, cols.ts)
    so_far = _ordered(cols).rowsBetween(W.unboundedPreceding, W.currentRow)
    return panel.withColumn(name, F.max(cols.price).over(so_far))


def with_adjacent_returns(
    panel: DataFrame, calendar: DataFrame, cols: PanelColumns = PANEL, name: str = "ret", by: tuple[str, ...] = ()
) -> DataFrame:
    """Return over neighbouring dates of a shared calendar; a gap voids two returns.

    `calendar` is (by, ts, day_index), one row per date of each calendar.
    """
    indexed = panel.join(calendar, [*by, cols.ts])
    w = W.partitionBy(cols.entity).orderBy("day_index")
    adjacent = F.lag("day_index").over(w) == F.col("day_index") - 1
    before = F.lag(cols.price).over(w)
    return indexed.withColumn(name, F.when(adjacent, F.try_divide(F.col(cols.price), before) - 1))


def calendar_of(panel: DataFrame, ts: str = "ts", by: tuple[str, ...] = ()) -> DataFrame:
    """Dates present in a panel with their running number from 0; `by` keeps calendars apart.

    The window sees distinct dates only, a few hundred a year.
    """
    require_dates(panel, ts)
    dates = panel.select(*by, ts).distinct()
    return dates.withColumn("day_index", F.row_number().over(W.partitionBy(*by).orderBy(ts)) - 1)


def flag_implausible_moves(
    panel: DataFrame, threshold: float = 0.20, cols: PanelColumns = PANEL
) -> DataFrame:
    """Mark large moves; the rows stay, since an amortisation looks the same."""
    moved = F.abs(F.try_divide(F.col(cols.price), F.lag(cols.price).over(_ordered(cols))) - 1)
    return panel.withColumn("implausible_move", F.coalesce(moved > threshold, F.lit(False)))


def flag_stale_prices(panel: DataFrame, max_days: int = 10, cols: PanelColumns = PANEL) -> DataFrame:
    """Mark the frozen days of runs in which a price stood still `max_days` or longer."""
    still = F.coalesce(F.col(cols.price) == F.lag(cols.price).over(_ordered(cols)), F.lit(False))
    so_far = _ordered(cols).rowsBetween(W.unboundedPreceding, W.currentRow)
    runs = panel.withColumn("_still", still).withColumn(
        "_run", F.sum(F.when(F.col("_still"), 0).otherwise(1)).over(so_far)
    )
    length = F.count(F.lit(1)).over(W.partitionBy(cols.entity, "_run"))
    return runs.withColumn(
        "stale_price", F.col("_still") & (length - 1 >= max_days)
    ).drop("_still", "_run")


def compounded(rate: Column) -> Column:
    """Aggregate: period rates chained into one; no rows give 0."""
    return F.coalesce(F.product(1 + rate), F.lit(1.0)) - 1


def endpoint_return(price: Column, ts: Column) -> Column:
    return F.try_divide(F.max_by(price, ts), F.min_by(price, ts)) - 1


def annualised_volatility(ret: Column, periods: int = PERIODS_PER_YEAR) -> Column:
    return F.stddev_samp(ret) * F.sqrt(F.lit(float(periods)))


def worst_drawdown(price: Column, peak: Column) -> Column:
    return F.min(F.try_divide(price, peak) - 1)


def negative_share(ret: Column) -> Column:
    return F.avg(F.when(ret.isNotNull(), (ret < 0).cast("double")))


def downside_volatility(
    ret: Column, threshold: float = 0.0, periods: int = PERIODS_PER_YEAR
) -> Column:
    """Volatility of the returns under a threshold; fewer than two give 0."""
    below = ret < F.lit(threshold)
    spread = F.stddev_samp(F.when(below, ret)) * F.sqrt(F.lit(float(periods)))
    return F.when(F.count_if(below) < 2, F.lit(0.0)).otherwise(spread)


def flow_stability(inflow: Column, outflow: Column, assets: Column) -> Column:
    """Net flow as a share of average assets; absent flows count as zero."""
    net = F.coalesce(F.sum(inflow), F.lit(0.0)) - F.coalesce(F.sum(outflow), F.lit(0.0))
    average = F.avg(assets)
    return F.when(average > 0, net / average)


def sound_series(panel: DataFrame, cols: PanelColumns = PANEL) -> DataFrame:
    """Entities whose series can be measured: two points or more, all usable."""
    return (
        panel.groupBy(cols.entity)
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.count_if(~numbers.usable_price(F.col(cols.price))).alias("unusable"),
        )
        .filter("observations >= 2 AND unusable = 0")
        .select(cols.entity, "observations")
    )


def metric_panel(
    panel: DataFrame,
    benchmark: Column,
    reference=None,
    by: tuple[str, ...] = (),
    cols: PanelColumns = PANEL,
    periods: int = PERIODS_PER_YEAR,
) -> DataFrame:
    """One row of measures per entity.

    `benchmark` is the compounded benchmark return over the same window, a
    literal or a scalar subquery. `by` holds further keys, such as a cut date.
    The window and the aggregate need the same distribution, so the panel is
    shuffled once.
    """
    require_dates(panel, cols.ts)
    if reference is not None:
        panel = panel.filter(F.col(cols.ts) <= F.lit(reference))
    keys = [*by, cols.entity]
    w = W.partitionBy(*keys).orderBy(cols.ts)
    so_far = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    price, ts = F.col(cols.price), F.col(cols.ts)
    prepared = panel.withColumns(
        {
            "_ret": F.try_divide(price, F.lag(price).over(w)) - 1,
            "_peak": F.max(price).over(so_far),
        }
    )
    ret = F.col("_ret")
    assets = numbers.finite_or_null(F.col(cols.assets).cast("double"))
    measured = prepared.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("observations"),
        F.min(ts).alias("first_date"),
        F.max(ts).alias("last_date"),
        endpoint_return(price, ts).alias("total_return"),
        annualised_volatility(ret, periods).alias("volatility"),
        worst_drawdown(price, F.col("_peak")).alias("max_drawdown"),
        negative_share(ret).alias("negative_days"),
        downside_volatility(ret, 0.0, periods).alias("downside_volatility"),
        F.avg(assets).alias("average_assets"),
        flow_stability(F.col(cols.inflow), F.col(cols.outflow), assets).alias("flow_stability"),
        F.count_if(~numbers.usable_price(price)).alias("_unusable"),
    )
    sound = measured.filter("observations >= 2 AND _unusable = 0").drop("_unusable")
    total, volatility = F.col("total_return"), F.col("volatility")
    return sound.withColumns(
        {
            "excess_return": numbers.excess_return(total, benchmark),
            "return_per_risk": numbers.return_per_risk(total, benchmark, volatility),
        }
    )


def benchmark_over(rates: DataFrame, start, end, ts: str = "ts", rate: str = "rate") -> DataFrame:
    """One row: the rates of a closed interval, compounded."""
    return rates.filter(F.col(ts).between(F.lit(start), F.lit(end))).agg(
        compounded(F.col(rate)).alias("benchmark")
    )


def with_benchmark_rate(
    returns: DataFrame, rates: DataFrame, ts: str = "ts", rate: str = "rate"
) -> DataFrame:
    """The benchmark's rate on each observation's own date, 0 where it has none.

    The rates are one row per date, so AQE broadcasts them by their real size.
    """
    known = rates.select(ts, F.col(rate).alias("_rate"))
    return (
        returns.join(known, ts, "left")
        .withColumn("benchmark_rate", F.coalesce("_rate", F.lit(0.0)))
        .drop("_rate")
    )


def summarise_series(panel: DataFrame, reference, cols: PanelColumns = PANEL) -> DataFrame:
    """Count, span, and the latest assets and holders per entity."""
    ts = F.col(cols.ts)
    return (
        panel.filter(ts <= F.lit(reference))
        .groupBy(cols.entity)
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.min(ts).alias("first_date"),
            F.max(ts).alias("last_date"),
            F.max_by(F.struct(cols.assets, cols.holders), ts).alias("_last"),
        )
        .select(
            cols.entity,
            "observations",
            "first_date",
            "last_date",
            F.col(f"_last.{cols.assets}").alias(cols.assets),
            F.col(f"_last.{cols.holders}").alias(cols.holders),
        )
    )
