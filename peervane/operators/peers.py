"""Peer-relative scoring: groups, percentiles, effective weights, scores.

All profiles are scored in one plan, with `profile` as a key of every step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peervane.functions.numbers import clip
from peervane.operators.order_stats import (
    average_rank,
    dispersion,
    distinct_values,
    quantiles,
    value_counts,
)
from peervane.params import Profile, Scoring, literal_table, metrics_of, weights_table
from peervane.session import materialise

# Fixed value: the label of the group that stands for the whole pool.
WHOLE_POOL = "(universo inteiro)"


def eligible(eligibility, columns: Sequence[str]) -> Column:
    """Membership, a ceiling a null passes, and a ceiling a null fails."""
    rule = F.lit(True)
    if eligibility.target_investor is not None and "target_investor" in columns:
        rule = rule & F.col("target_investor").isin(list(eligibility.target_investor))
    if eligibility.max_minimum_investment is not None and "minimum_investment" in columns:
        least = F.col("minimum_investment")
        rule = rule & (least.isNull() | (least <= float(eligibility.max_minimum_investment)))
    if eligibility.max_redemption_days is not None and "redemption_days" in columns:
        rule = rule & (F.col("redemption_days") <= int(eligibility.max_redemption_days))
    return F.coalesce(rule, F.lit(False))


def profile_pools(funds: DataFrame, profiles: Sequence[Profile]) -> DataFrame:
    """One row per (profile, eligible entity), in a single pass over the entities."""
    ids = F.array_compact(
        F.array(
            *[F.when(eligible(p.eligibility, funds.columns), F.lit(p.profile_id)) for p in profiles]
        )
    )
    return funds.select(F.explode(ids).alias("profile"), "*")


def with_peer_groups(
    pool: DataFrame, group: str, min_size: int, by: Sequence[str] = ("profile",)
) -> DataFrame:
    """Add `peer_group`, `peer_size` and `pool_size`; small groups join the whole pool.

    Sizes come from map-side counts; the table joined back holds one row per
    group, and AQE picks the join by its measured size.
    """
    by = list(by)
    sizes = pool.groupBy(*by, group).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("pool_size", F.sum("_n").over(W.partitionBy(*by)))
    own = F.col(group).isNotNull() & (F.col("_n") >= min_size)
    sizes = sizes.select(
        *[F.col(k).alias(f"_k_{k}") for k in by], F.col(group).alias("_g"), "pool_size",
        F.when(own, F.col(group)).otherwise(F.lit(WHOLE_POOL)).alias("peer_group"),
        F.when(own, F.col("_n")).otherwise(F.col("pool_size")).alias("peer_size"),
    )
    match = F.col(group).eqNullSafe(F.col("_g"))
    for k in by:
        match = match & (F.col(k) == F.col(f"_k_{k}"))
    return pool.join(sizes, match).drop("_g", *[f"_k_{k}" for k in by])


def metric_rows(pool: DataFrame, metrics: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """Long form: (carried, metric, value), a row per metric.

    One window then serves every metric, and metrics spread over the tasks.
    """
    pairs = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    return pool.selectExpr(*carried, f"stack({len(metrics)}, {pairs}) AS (metric, value)")


def metric_counts(pool: DataFrame, metrics: Sequence[str], by: Sequence[str] = ("profile",)) -> DataFrame:
    """`value_counts` of many metrics at once, keyed by (by, metric)."""
    return value_counts(metric_rows(pool, metrics, by), [*by, "metric"], "value")


def metric_dispersion(pool: DataFrame, metrics: Sequence[str], by: Sequence[str] = ("profile",)) -> DataFrame:
    """(by, metric, dispersion): counts alone, nothing is ordered."""
    keys = [*by, "metric"]
    return dispersion(distinct_values(metric_rows(pool, metrics, by), keys, "value"), keys)


def clip_bounds(counts: DataFrame, lower: float, upper: float, by: Sequence[str] = ("profile",)) -> DataFrame:
    return quantiles(counts, [*by, "metric"], "value", {"low": lower, "high": upper})


def effective_weights(weights: DataFrame, spread: DataFrame, min_dispersion: float) -> DataFrame:
    """Move the weight of metrics that cannot separate onto those that can.

    `spread` is (profile, metric, dispersion). Rounding is half to even, and what
    rounding leaves over goes to the heaviest metric. A window here holds the
    metrics of one profile, which the parameters bound.
    """
    judged = weights.join(spread, ["profile", "metric"], "left")
    live = F.coalesce(F.col("dispersion") >= min_dispersion, F.lit(False))
    w = W.partitionBy("profile")
    judged = judged.withColumns(
        {
            "_live": live,
            "_live_total": F.sum(F.when(live, F.col("weight"))).over(w),
            "_dead": F.count_if(~live).over(w),
        }
    )
    unchanged = (F.col("_dead") == 0) | F.col("_live_total").isNull()
    rounded = F.when(unchanged, F.col("weight")).when(
        F.col("_live"), F.bround(F.try_divide(F.col("weight") * 100, F.col("_live_total")), 0).cast("int")
    ).otherwise(F.lit(0))
    judged = judged.withColumn("_rounded", rounded)
    heaviest = F.row_number().over(w.orderBy(F.desc("_rounded"), "ord")) == 1
    drift = 100 - F.sum("_rounded").over(w)
    return judged.select(
        "profile", "metric", "ord", "weight", "jitter",
        F.coalesce("dispersion", F.lit(0.0)).alias("dispersion"),
        (F.col("_rounded") + F.when(heaviest & ~unchanged, drift).otherwise(0)).cast("int").alias("effective_weight"),
        (~F.col("_live") & ~unchanged).alias("inert"),
    )


def inert_metrics(weights: DataFrame, live: DataFrame) -> DataFrame:
    """Declared metrics less the live ones."""
    return weights.select("profile", "metric").join(live.select("profile", "metric"), ["profile", "metric"], "left_anti")


def clipped_rows(rows: DataFrame, bounds: DataFrame, by: Sequence[str] = ("profile",)) -> DataFrame:
    """Bound each long value; `bounds` has a row per (by, metric)."""
    joined = rows.join(bounds, [*by, "metric"], "left")
    return joined.withColumn("value", clip(F.col("value"), F.col("low"), F.col("high"))).drop("low", "high")


def winsorised(
    pool: DataFrame, bounds: DataFrame, metrics: Sequence[str], by: Sequence[str] = ("profile",)
) -> DataFrame:
    """(by, entity, metrics) with each metric clipped to its pool's bounds."""
    by = list(by)
    rows = clipped_rows(metric_rows(pool, metrics, [*by, "entity"]), bounds, by)
    return widened(rows, [*by, "entity"], metrics, {"value": ""})


def widened(
    rows: DataFrame, keys: Sequence[str], metrics: Sequence[str], columns: Mapping[str, str]
) -> DataFrame:
    """Back to a row per entity: `columns` maps a long column to the suffix of its wide ones."""
    return rows.groupBy(*keys).agg(
        *[
            F.expr(f"max(CASE WHEN metric = '{m}' THEN {c} END) AS `{m}{suffix}`")
            for m in metrics
            for c, suffix in columns.items()
        ]
    )


def as_percentile(rank: Column, size: Column) -> Column:
    """0 (worst) to 1 (best); a group of one says nothing and gets 0.5."""
    return F.when(size > 1, (rank - 1) / (size - 1)).otherwise(F.lit(0.5))


def low_is_good(metrics: Sequence[str], directions: Mapping[str, str]) -> list[str]:
    wrong = {directions[m] for m in metrics} - {"high", "low"}
    if wrong:
        raise ValueError(f"direction must be 'high' or 'low', got {sorted(wrong)}")
    return [m for m in metrics if directions[m] == "low"]


def percentile_rows(
    rows: DataFrame, metrics: Sequence[str], directions: Mapping[str, str],
    by: Sequence[str] = ("profile",),
) -> DataFrame:
    """Add `pct` within the peer group and `pool_pct` in the whole pool to long rows.

    Expects `peer_group`, `peer_size` and `pool_size`. Values of metrics where low
    is good are negated, so that the same ascending rank is always best last. The
    denominator counts rows whose metric is null, the ranks do not. The rows are stored: both ranks read them.
    """
    negated = low_is_good(metrics, directions)
    signed = F.when(F.col("metric").isin(negated), -F.col("value")).otherwise(F.col("value"))
    rows = materialise(rows.withColumn("value", signed), "metric-rows")
    keys = [*by, "metric"]
    ranked = average_rank(rows, [*keys, "peer_group"], "value", "_rank")
    pool_ranks = value_counts(rows, keys, "value").select(
        *keys, "value", (F.col("below") + (F.col("n") + 1) / F.lit(2.0)).alias("_pool_rank")
    )
    ranked = ranked.join(pool_ranks, [*keys, "value"], "left")
    pool_pct = as_percentile(F.col("_pool_rank"), F.col("pool_size"))
    peer_pct = as_percentile(F.col("_rank"), F.col("peer_size"))
    return ranked.withColumns(
        {
            "pct": F.when(F.col("peer_group") == WHOLE_POOL, pool_pct).otherwise(peer_pct),
            "pool_pct": pool_pct,
        }
    ).drop("_rank", "_pool_rank")


def weighted_score(metrics: Sequence[str], suffix: str = "_pct") -> Column:
    """Sum of percentile times `w_{metric}`; an unknown percentile counts one half.

    Terms are added in the order of the metrics, so equal inputs tie exactly.
    """
    terms = [f"coalesce(`{m}{suffix}`, 0.5D) * `w_{m}`" for m in metrics]
    return F.expr(" + ".join(["0.0D", *terms]))


def weights_wide(weights: DataFrame, metrics: Sequence[str], value: str, by: Sequence[str] = ("profile",)) -> DataFrame:
    """One row per `by` with a `w_{metric}` column each, 0 for metrics not weighed."""
    return weights.groupBy(*by).agg(
        *[
            F.expr(f"coalesce(sum(CASE WHEN metric = '{m}' THEN {value} END), 0) AS `w_{m}`")
            for m in metrics
        ]
    )


STATISTICS = ("profile", "metric", "ord", "weight", "jitter", "dispersion", "effective_weight", "inert")
BOUNDS = ("profile", "metric", "low", "high")


def pool_statistics(
    pool: DataFrame, profiles: Sequence[Profile], metrics: Sequence[str], scoring: Scoring
) -> tuple[DataFrame, DataFrame]:
    """Weights in force, and clip bounds of every metric of every pool, weighed there or not, as literal tables.

    One table of counts serves both. Their rows number profiles x metrics, which the
    parameters bound, so they pass through the driver and become part of the plan.
    """
    spark = pool.sparkSession
    counts = metric_counts(pool, metrics)
    weights = effective_weights(
        weights_table(spark, profiles), dispersion(counts, ["profile", "metric"]), scoring.min_dispersion
    )
    bounds = clip_bounds(counts, scoring.lower, scoring.upper)
    # The types are spelled out: a literal table of an empty pool has no rows to take them from.
    none = spark.createDataFrame([], "profile string, metric string, low double, high double")
    found = sorted(bounds.select(*BOUNDS).collect())
    return (
        literal_table(spark, STATISTICS, sorted(weights.select(*STATISTICS).collect())),
        literal_table(spark, BOUNDS, found) if found else none,
    )


def score_profiles(
    pool: DataFrame, profiles: Sequence[Profile], directions: Mapping[str, str],
    scoring: Scoring = Scoring(), group: str = "grp",
) -> tuple[DataFrame, DataFrame]:
    """Scores of every profile's pool, and the weights that made them.

    Returns the pool with percentiles, `score` and `pool_score`, and the table of
    effective weights. `pool` should be a stored table: it is read for the
    counts and again for the scores.
    """
    metrics = [m for m in metrics_of(profiles) if m in pool.columns]
    weights, bounds = pool_statistics(pool, profiles, metrics, scoring)
    grouped = with_peer_groups(pool, group, scoring.min_group)
    sizes = ["peer_group", "peer_size", "pool_size"]
    rows = metric_rows(grouped, metrics, ["profile", "entity", *sizes])
    rows = clipped_rows(rows, bounds)
    ranked = percentile_rows(rows, metrics, directions)
    percentiles = widened(
        ranked, ["profile", "entity", *sizes], metrics, {"pct": "_pct", "pool_pct": "_pool_pct"}
    )
    wide = weights_wide(weights, metrics, "effective_weight")
    scored = percentiles.join(wide, "profile").withColumns(
        {"score": weighted_score(metrics), "pool_score": weighted_score(metrics, "_pool_pct")}
    )
    scored = pool.join(scored.drop(*[f"w_{m}" for m in metrics]), ["profile", "entity"])
    return scored, weights
