"""Fees measured against the fund a class holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peervane.functions.numbers import annual_fee, max_ignoring_null
from peervane.operators.series import PANEL, PanelColumns


def heaviest_edge(
    edges: DataFrame, min_share: float, src: str = "src", dst: str = "dst", value: str = "value"
) -> DataFrame:
    """(src, dst, share) where one target holds at least `min_share` of a source.

    Two partial aggregates: edges to the same target are summed first, then the
    heaviest target and the total are taken together. Ties go to the larger key.
    """
    summed = edges.groupBy(src, dst).agg(F.sum(value).alias("_v"))
    best = summed.groupBy(src).agg(
        F.sum("_v").alias("_total"), F.max(F.struct("_v", dst)).alias("_best")
    )
    return (
        best.filter("_total > 0")
        .select(src, F.col(f"_best.{dst}").alias(dst), F.try_divide("_best._v", "_total").alias("share"))
        .filter(F.col("share") >= min_share)
    )


def measured_fees(
    panel: DataFrame, links: DataFrame, periods: int = 252, min_overlap: int = 60,
    cols: PanelColumns = PANEL, src: str = "src", dst: str = "dst",
) -> DataFrame:
    """(src, measured_fee, measured_days) from the days a class shares with its master.

    The link table keeps one target per source, so the joins cannot multiply
    rows; the second one spreads a master that many classes hold over its dates.
    """
    quotas = panel.select(cols.entity, cols.ts, cols.price)
    own = links.select(src, dst).join(quotas.withColumnRenamed(cols.entity, src), src)
    masters = quotas.select(
        F.col(cols.entity).alias(dst), cols.ts, F.col(cols.price).alias("_master")
    )
    both = own.join(masters, [dst, cols.ts])
    ts, price, master = F.col(cols.ts), F.col(cols.price), F.col("_master")
    ends = F.struct(price.alias("own"), master.alias("master"))
    grown = both.groupBy(src).agg(
        F.count(F.lit(1)).alias("measured_days"),
        F.min_by(ends, ts).alias("_first"),
        F.max_by(ends, ts).alias("_last"),
    )
    own_growth, master_growth = (F.try_divide(f"_last.{s}", f"_first.{s}") for s in ("own", "master"))
    retained = F.try_divide(own_growth, master_growth)
    years = (F.col("measured_days") - 1) / F.lit(float(periods))
    return (
        grown.filter((F.col("measured_days") >= min_overlap) & (F.col("measured_days") > 1))
        .filter((F.col("_first.own") > 0) & (F.col("_first.master") > 0) & (F.col("_last.master") > 0))
        .withColumns({"_retained": retained, "_years": years})
        .filter((F.col("_retained") > 0) & (F.col("_years") > 0))
        .select(src, annual_fee(F.col("_retained"), F.col("_years")).alias("measured_fee"), "measured_days")
        .filter("measured_fee >= 0")
    )


def reconcile_fees(
    funds: DataFrame, measurements: DataFrame, key: str, fee: str = "fee",
    invests_through_funds: str = "holds_funds",
) -> DataFrame:
    """One fee per entity: the higher of filed and measured, null if unverifiable."""
    if "declared_fee" not in funds.columns:
        funds = funds.withColumn("declared_fee", F.col(fee))
    joined = funds.join(measurements.select(key, "measured_fee"), key, "left").withColumn(
        fee, max_ignoring_null(F.col(fee), F.col("measured_fee"))
    )
    if invests_through_funds not in funds.columns:
        return joined
    flagged = F.upper(F.trim(invests_through_funds)) == "S"
    unverifiable = F.coalesce(flagged & F.col("measured_fee").isNull(), F.lit(False))
    return joined.withColumn(fee, F.when(~unverifiable, F.col(fee)))
