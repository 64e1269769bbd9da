"""What the chosen entities did afterwards, against chance and against cost.

The cut date is a column: one plan measures every cut and every profile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peervane.functions.numbers import usable_price
from peervane.functions.uniform import uniform
from peervane.operators.order_stats import quantiles, value_counts
from peervane.operators.series import PANEL, PanelColumns, endpoint_return
from peervane.params import Backtest

GROUP = ("cut_date", "profile")
MEMBER_RANGES = 256
MIN_PRICED = 8
COMPARED_DIGITS = 12
# Portfolio size against which a pool without a selection is set.
UNSELECTED_SIZE = 5


def by_cut(frame: DataFrame, cuts: Sequence, rule) -> DataFrame:
    """Repeat each row for the cut dates it belongs to: a filter per cut, one scan."""
    dates = F.array(*[F.lit(c) for c in cuts])
    return frame.withColumn("cut_date", F.explode(F.filter(dates, rule)))


def forward_returns(panel: DataFrame, rules: Backtest, cols: PanelColumns = PANEL) -> DataFrame:
    """(cut_date, entity, forward_return) over the days strictly after each cut."""
    ts, price = F.col(cols.ts), F.col(cols.price)
    window = panel.filter((ts > F.lit(min(rules.cut_dates))) & (ts <= F.lit(rules.end_date)))
    repeated = by_cut(window.select(cols.entity, cols.ts, cols.price), rules.cut_dates, lambda c: ts > c)
    return (
        repeated.groupBy("cut_date", F.col(cols.entity).alias("entity"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if(~usable_price(price)).alias("_unusable"),
            endpoint_return(price, ts).alias("forward_return"),
        )
        .filter("_n >= 2 AND _unusable = 0")
        .select("cut_date", "entity", "forward_return")
    )


def benchmark_returns(rates: DataFrame, rules: Backtest, ts: str = "ts", rate: str = "rate") -> DataFrame:
    """(cut_date, benchmark_return): a row per cut, 0 where no rate falls after it."""
    day = F.col(ts)
    window = rates.filter(day <= F.lit(rules.end_date))
    after = F.coalesce(F.product(F.when(day > F.col("cut_date"), 1 + F.col(rate))), F.lit(1.0)) - 1
    return by_cut(window, rules.cut_dates, lambda c: c.isNotNull()).groupBy("cut_date").agg(
        after.alias("benchmark_return")
    )


def discontinued(panel: DataFrame, rules: Backtest, cols: PanelColumns = PANEL) -> DataFrame:
    """Entities whose series stops well before the end."""
    last = panel.groupBy(F.col(cols.entity).alias("entity")).agg(F.max(cols.ts).alias("last_date"))
    return last.filter(F.col("last_date") < F.date_sub(F.lit(rules.end_date), rules.tolerance_days))


def numbered_members(members: DataFrame, groups: Sequence[str] = GROUP, ranges: int = MEMBER_RANGES) -> DataFrame:
    """Add `slot` (0..n-1 within a group) and `members` (n), without ordering a whole group.

    Members fall into ranges by the first hex digits of their key's md5; each range
    is numbered on its own and offset by the ranges before it.
    """
    groups = list(groups)
    digest = F.md5(F.col("entity").cast("string").cast("binary"))
    digits = 1 if ranges <= 16 else 2 if ranges <= 256 else 3
    ranged = members.withColumns({"_digest": digest, "_range": F.substring(digest, 1, digits)})
    counts = ranged.groupBy(*groups, "_range").agg(F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy(*groups)
    before = F.sum("_n").over(w.orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow))
    offsets = counts.select(
        *groups, "_range", (before - F.col("_n")).alias("_before"), F.sum("_n").over(w).alias("members")
    )
    inside = W.partitionBy(*groups, "_range").orderBy("_digest", "entity")
    return (
        ranged.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(offsets, [*groups, "_range"])
        .withColumn("slot", F.col("_before") + F.col("_inside"))
        .drop("_digest", "_range", "_before", "_inside")
    )


def subset_slots(size: Column, members: Column, seed: int, draw: Column) -> Column:
    """A random `size`-subset of 0..members-1, from `size` uniforms (Floyd's method).

    Takes the same work from a pool of ten and a pool of a billion.
    """
    code = F.lit(0)
    empty = F.array().cast("array<bigint>")

    def place(chosen: Column, j: Column) -> Column:
        pick = F.floor(uniform(seed, draw, code, j) * (j + 1)).cast("bigint")
        return F.when(F.array_contains(chosen, pick), F.array_append(chosen, j)).otherwise(
            F.array_append(chosen, pick)
        )

    take = F.least(size.cast("bigint"), members)
    return F.when(members > 0, F.aggregate(F.sequence(members - take, members - 1), empty, place))


def random_portfolios(
    members: DataFrame, sizes: DataFrame, draws: int, seed: int, value: str = "forward_return",
    groups: Sequence[str] = GROUP,
) -> DataFrame:
    """(groups, draw, portfolio_return): equal-weight random subsets of each group.

    `sizes` is (groups, size). Only the drawn slots are joined to the members:
    draws x size rows for a group, however many members it has.
    """
    groups = list(groups)
    numbered = numbered_members(members.select(*groups, "entity", value), groups)
    totals = members.groupBy(*groups).agg(F.count(F.lit(1)).alias("members"))
    drawn = totals.join(sizes, groups).select(
        *groups, "members", "size", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw")
    )
    slots = drawn.select(
        *groups, "draw", F.explode(subset_slots(F.col("size"), F.col("members"), seed, F.col("draw"))).alias("slot")
    )
    held = slots.join(numbered.select(*groups, "slot", value), [*groups, "slot"])
    return held.groupBy(*groups, "draw").agg(F.avg(value).alias("portfolio_return"))


def cheapest_quartile(members: DataFrame, fee: str = "fee", groups: Sequence[str] = GROUP) -> DataFrame:
    """Members at or under the first fee quartile; fewer than eight priced keep all."""
    groups = list(groups)
    cuts = quantiles(value_counts(members, groups, fee), groups, fee, {"cut": 0.25})
    priced = members.groupBy(*groups).agg(F.count(fee).alias("_priced"))
    limits = priced.join(cuts, groups, "left")
    few = F.col("_priced") < MIN_PRICED
    return (
        members.join(limits, groups)
        .filter(few | F.coalesce(F.col(fee) <= F.col("cut"), F.lit(False)))
        .drop("_priced", "cut")
    )


def share_below(distribution: DataFrame, values: DataFrame, groups: Sequence[str], at: str, value: str, name: str) -> DataFrame:
    """(groups, name): the share of each group's distribution under a value.

    Both are rounded first: a portfolio of the very entities that were selected must
    tie with them, whatever order their returns were added in.
    """
    under = F.round(at, COMPARED_DIGITS) < F.round(value, COMPARED_DIGITS)
    return distribution.join(values, list(groups)).groupBy(*groups).agg(
        F.avg(under.cast("double")).alias(name)
    )


def medians(members: DataFrame, value: str, groups: Sequence[str] = GROUP) -> DataFrame:
    groups = list(groups)
    return quantiles(value_counts(members, groups, value), groups, value, {"median": 0.5})


def evaluate(
    selected: DataFrame, pools: DataFrame, forward: DataFrame, benchmark: DataFrame,
    stopped: DataFrame, rules: Backtest,
) -> DataFrame:
    """One row per cut and profile: the selection against four comparisons.

    `selected` is (cut_date, profile, entity), `pools` the same with `fee`: all
    that could have been chosen. A selected entity without a later price is held
    flat and counted as carried. Pools need their own forward return; selected
    entities are looked up among all. A pool from which nothing was selected has a
    row as well: its return is 0 and is set against portfolios of `UNSELECTED_SIZE`.
    """
    groups = list(GROUP)
    picked = selected.select(*groups, "entity").join(forward, ["cut_date", "entity"], "left").join(
        stopped.select("entity", F.lit(True).alias("_stopped")), "entity", "left"
    )
    every = pools.select(*groups).unionByName(selected.select(*groups)).distinct()
    chosen = F.col("entity").isNotNull()
    held = F.coalesce("forward_return", F.lit(0.0))
    realised = pools.select(*groups, "entity", "fee").join(forward, ["cut_date", "entity"])
    outcome = every.join(picked, groups, "left").groupBy(*groups).agg(
        F.coalesce(F.avg(F.when(chosen, held)), F.lit(0.0)).alias("selected_return"),
        F.coalesce(F.nullif(F.count("entity"), F.lit(0)), F.lit(UNSELECTED_SIZE)).alias("size"),
        F.sort_array(F.collect_list("entity")).alias("selected"),
        F.sort_array(F.collect_list(F.when(F.col("forward_return").isNull(), F.col("entity")))).alias("carried"),
        F.sort_array(F.collect_list(F.when(F.col("_stopped"), F.col("entity")))).alias("discontinued"),
    )
    middle = medians(realised, "forward_return")
    beaten = (
        picked.join(middle, groups)
        .groupBy(*groups)
        .agg(F.count_if(held > F.col("median")).alias("beat_median"))
    )
    sizes = outcome.select(*groups, "size")
    returns = outcome.select(*groups, "selected_return")
    chance = random_portfolios(realised, sizes, rules.portfolios, rules.seed)
    cheap = random_portfolios(cheapest_quartile(realised), sizes, rules.portfolios, rules.seed)
    scored = outcome.join(middle, groups, "left").join(beaten, groups, "left")
    for portfolios, name in ((chance, "random_percentile"), (cheap, "cheap_percentile")):
        beat = share_below(portfolios, returns, groups, "portfolio_return", "selected_return", name)
        scored = scored.join(beat, groups, "left")
    scored = scored.join(benchmark, "cut_date", "left")
    zero = F.lit(0.0)
    return scored.select(
        *groups, "selected", "selected_return",
        F.coalesce("median", zero).alias("peer_median_return"),
        F.coalesce("benchmark_return", zero).alias("benchmark_return"),
        F.coalesce("random_percentile", zero).alias("random_percentile"),
        F.coalesce("cheap_percentile", zero).alias("cheap_percentile"),
        F.coalesce("beat_median", F.lit(0)).alias("beat_median"),
        "discontinued", "carried",
    ).withColumns(
        {
            "excess_over_median": F.col("selected_return") - F.col("peer_median_return"),
            "excess_over_benchmark": F.col("selected_return") - F.col("benchmark_return"),
        }
    )


def verdict(outcomes: DataFrame, rules: Backtest) -> DataFrame:
    """(profile, dates_passed, dates_tested, passed, method_passed): every profile must clear."""
    cleared = F.col("random_percentile") > F.lit(rules.success_percentile / 100)
    per_profile = outcomes.groupBy("profile").agg(
        F.count_if(cleared).alias("dates_passed"), F.count(F.lit(1)).alias("dates_tested")
    ).withColumn("passed", F.col("dates_passed") >= rules.success_min_dates)
    return per_profile.withColumn("method_passed", F.bool_and("passed").over(W.partitionBy()))


def edge_summary(outcomes: DataFrame) -> DataFrame:
    """One row: the range of edges in basis points and how many beat what."""
    edge = F.col("excess_over_median") * 10_000
    return outcomes.agg(
        F.min(edge).alias("min_edge_bp"), F.max(edge).alias("max_edge_bp"),
        F.count_if(F.col("excess_over_median") > 0).alias("beat_median"),
        F.count_if(F.col("excess_over_benchmark") > 0).alias("beat_benchmark"),
        F.min("cheap_percentile").alias("min_cheap_percentile"),
        F.max("cheap_percentile").alias("max_cheap_percentile"),
        F.count(F.lit(1)).alias("tested"),
    )


def outcome_report(outcomes: DataFrame) -> DataFrame:
    """The published table: a row per cut and profile, edges in basis points."""
    return outcomes.select(
        *GROUP, "selected_return", "benchmark_return", "peer_median_return",
        (F.col("excess_over_median") * 10_000).alias("edge_bp"),
        "random_percentile", "cheap_percentile", "beat_median",
    ).orderBy(*GROUP)
