"""The eligibility funnel, counted at every step in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peervane.params import Filters, literal_table

RECEIVED = "registered_classes"


class FunnelDeviationError(RuntimeError):
    """The universe is not the size it should be."""


def any_pattern(text: Column, patterns: Sequence[str]) -> Column:
    return text.rlike("|".join(f"(?:{p})" for p in patterns))


def lacks_marker(name: Column, markers: Sequence[str]) -> Column:
    """True unless the upper-cased name matches a marker; a null name passes."""
    return ~F.coalesce(F.upper(name).rlike("|".join(markers)), F.lit(False))


def blank_undisclosed(funds: DataFrame, fee: str = "fee") -> DataFrame:
    """A fee of exactly zero is unknown, not free; what was filed stays beside it."""
    filed = F.col("declared_fee") if "declared_fee" in funds.columns else F.col(fee)
    zero = F.coalesce(F.col(fee) == 0, F.lit(False))
    return funds.withColumns(
        {"declared_fee": filed, "zero_declared": zero, fee: F.when(~zero, F.col(fee))}
    )


def holder_evidence(profile: DataFrame, key: str) -> DataFrame:
    """(key, reached): whether any filing of a class shows an individual inside."""
    seen = (F.col("individuals") > 0) | (F.col("distributors") > 0)
    return profile.groupBy(key).agg(F.bool_or(F.coalesce(seen, F.lit(False))).alias("reached"))


def reachable(funds: DataFrame, profile: DataFrame, key: str) -> DataFrame:
    """Keep classes with evidence of individuals, or with no filing at all."""
    joined = funds.join(holder_evidence(profile, key), key, "left")
    return joined.filter(F.coalesce("reached", F.lit(True))).drop("reached")


def with_first_failure(frame: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add `failed_step`: the number of the first rule a row fails, null for none.

    A rule that evaluates to null fails, as a filter would drop the row.
    """
    failed = None
    for number, (_, rule) in enumerate(steps, start=1):
        broken = ~F.coalesce(rule, F.lit(False))
        failed = F.when(broken, number) if failed is None else failed.when(broken, number)
    return frame.withColumn("failed_step", failed)


def funnel_counts(judged: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """(ord, step, observed): rows left after each rule, from one aggregate.

    The aggregate leaves a row per step; the running sum works on those alone.
    """
    spark = judged.sparkSession
    names = [RECEIVED, *[name for name, _ in steps]]
    by_step = judged.groupBy(F.coalesce("failed_step", F.lit(len(names))).alias("ord")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    listed = literal_table(spark, ["ord", "step"], list(enumerate(names)))
    lost = listed.join(by_step, "ord", "full").withColumn("_n", F.coalesce("_n", F.lit(0)))
    later = W.orderBy("ord").rowsBetween(1, W.unboundedFollowing)
    return (
        lost.withColumn("observed", F.coalesce(F.sum("_n").over(later), F.lit(0)))
        .filter("step IS NOT NULL")
        .select(F.col("ord").cast("int").alias("ord"), "step", "observed")
    )


def universe_steps(filters: Filters, columns: Sequence[str], with_profile: bool) -> list[tuple[str, Column]]:
    """The rules in order, over the registry joined with summary, terms and holders."""
    c = F.col
    exclusive_rule = c("exclusive") != "S" if filters.exclude_exclusive else F.lit(True)
    marker_rule = (
        lacks_marker(c("name"), filters.exclude_name_markers)
        if filters.exclude_name_markers and "name" in columns
        else F.lit(True)
    )
    terms_rule = (
        c("fee").isNotNull() & c("redemption_days").isNotNull()
        if filters.require_fee_and_redemption
        else F.lit(True)
    )
    steps = [
        ("fixed_income", any_pattern(c("classification"), filters.classification)),
        ("operating", c("status").isin(list(filters.status))),
        ("open_ended", c("condominium").isin(list(filters.condominium))),
        ("non_exclusive", exclusive_rule),
        ("not_cash_sweep", marker_rule),
        ("with_quota_series", c("observations").isNotNull()),
        ("with_enough_observations", c("observations") >= filters.min_observations),
        ("above_min_assets", c("assets") >= filters.min_assets),
        ("above_min_shareholders", c("holders") >= filters.min_holders),
        ("with_fee_and_redemption", terms_rule),
        ("reachable_by_individuals", F.coalesce("reached", F.lit(True)) if with_profile else F.lit(True)),
    ]
    return steps


def build_universe(
    registry: DataFrame, summary: DataFrame, terms: DataFrame, filters: Filters,
    investor_profile: DataFrame | None = None, key: str = "entity",
) -> tuple[DataFrame, DataFrame]:
    """(funds, funnel). The summary, terms and holder tables hold one row per key.

    The three left joins keep every registry row, so one aggregate over the
    first failed step counts the whole funnel.
    """
    from peervane.operators.joins import without_overlap

    frame = registry
    for part in (summary, terms):
        frame = without_overlap(frame, part, [key]).join(part, key, "left")
    if investor_profile is not None:
        frame = frame.join(holder_evidence(investor_profile, key), key, "left")
    steps = universe_steps(filters, frame.columns, investor_profile is not None)
    judged = with_first_failure(frame, steps)
    funds = judged.filter("failed_step IS NULL").drop("failed_step", "reached")
    return blank_undisclosed(funds), funnel_counts(judged, steps)


def count_by(frame: DataFrame, column: str) -> DataFrame:
    return frame.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def compare_funnel(observed: DataFrame, expected: Mapping[str, int], tolerance: float) -> DataFrame:
    """(ord, step, observed, expected, deviation, ok) for the steps with a baseline."""
    baseline = literal_table(observed.sparkSession, ["step", "expected"], list(expected.items()))
    joined = observed.join(baseline, "step")
    gap = (F.col("observed") - F.col("expected")) / F.col("expected")
    deviation = F.when(
        F.col("expected") == 0, F.when(F.col("observed") == 0, 0.0).otherwise(1.0)
    ).otherwise(gap)
    return joined.withColumn("deviation", deviation).select(
        "ord", "step", "observed", "expected", "deviation",
        (F.abs("deviation") <= tolerance).alias("ok"),
    )


def worst_step(report: DataFrame) -> DataFrame:
    """One row: the step furthest outside its baseline, if any is."""
    off = report.filter(~F.col("ok"))
    return off.orderBy(F.desc(F.abs("deviation")), "ord").limit(1)


def raise_if_off(report: DataFrame) -> None:
    worst = worst_step(report).first()
    if worst is not None:
        raise FunnelDeviationError(f"{worst['step']} is {worst['deviation']:+.1%} off its baseline")
