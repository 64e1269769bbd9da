"""One ranking: from tables to the lists each profile would publish."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peervane.functions.dates import track_record, window_start_date
from peervane.functions.numbers import log_size
from peervane.functions.tax import tax_efficiency, tax_regime
from peervane.functions.uniform import entity_code
from peervane.operators.asof import combine_terms, in_force
from peervane.operators.joins import assert_unique, without_overlap
from peervane.operators.links import heaviest_edge, measured_fees, reconcile_fees
from peervane.operators.peers import profile_pools, score_profiles
from peervane.operators.resample import aligned_returns, stability
from peervane.operators.selection import gated_selection, manager_share, with_gates
from peervane.operators.series import benchmark_over, metric_panel, summarise_series
from peervane.operators.twins import Twins, both_directions, pool_returns, twin_classes
from peervane.operators.universe import build_universe, compare_funnel, raise_if_off
from peervane.params import (
    DIRECTIONS,
    Filters,
    Profile,
    Resampling,
    Scoring,
    Selection,
    metrics_of,
)
from peervane.session import materialise

SCORED_ALIASES = ("size", "track_record", "tax_efficiency", "tax_regime")


@dataclass(frozen=True)
class Inputs:
    """Clean tables, keyed by `entity`.

    panel: entity, ts, price, assets, inflow, outflow, holders
    registry: entity, name, grp, manager, classification, status, condominium, exclusive,
        target_investor, long_term, constituted, holds_funds
    primary_terms, fallback_terms: entity, ts, fee, redemption_days, minimum_investment
    holdings: src, dst, value     rates: ts, rate     holders: entity, individuals, distributors
    """

    panel: DataFrame
    registry: DataFrame
    primary_terms: DataFrame
    fallback_terms: DataFrame
    rates: DataFrame
    holdings: DataFrame | None = None
    holders: DataFrame | None = None


@dataclass(frozen=True)
class Settings:
    profiles: Sequence[Profile]
    filters: Filters
    months: int = 12
    periods: int = 252
    scoring: Scoring = Scoring()
    selection: Selection = Selection()
    resampling: Resampling = Resampling()
    min_master_share: float = 0.95
    min_fee_overlap: int = 60
    directions: Mapping[str, str] = field(default_factory=lambda: DIRECTIONS)
    expected_funnel: Mapping[str, int] = field(default_factory=dict)
    funnel_tolerance: float = 0.03
    on_deviation: str = "report"
    zero_fee: str = "pass"
    prefix: int = 64


@dataclass(frozen=True)
class Ranking:
    funds: DataFrame
    funnel: DataFrame
    scored: DataFrame
    weights: DataFrame
    found: Twins
    listed: DataFrame
    displaced: DataFrame
    struck: DataFrame
    shares: DataFrame
    start: dt.date

    @property
    def twins(self) -> DataFrame:
        """(entity, twin, distance): all pairs of the pools from both ends, measured when asked for."""
        return both_directions(self.found.expanded)


def terms_in_force(inputs: Inputs, settings: Settings, series: DataFrame, reference: dt.date) -> DataFrame:
    """Coalesced terms as of the reference date with the fee reconciled."""
    complete = ["fee", "redemption_days"]
    columns = ["entity", *complete, "minimum_investment"]
    primary = in_force(inputs.primary_terms, "entity", "ts", reference).select(*columns)
    fallback = inputs.fallback_terms
    if "ts" in fallback.columns:
        fallback = in_force(fallback, "entity", "ts", reference)
    terms = combine_terms(primary, fallback.select(*columns), "entity", complete, ("EXTRATO", "LAMINA"))
    if settings.zero_fee == "unknown":
        terms = terms.filter("fee <> 0")
    if inputs.holdings is None:
        return terms.withColumns(
            {"declared_fee": F.col("fee"), "measured_fee": F.lit(None).cast("double")}
        )
    links = heaviest_edge(inputs.holdings, settings.min_master_share)
    fees = measured_fees(series, links, settings.periods, settings.min_fee_overlap)
    if "holds_funds" in inputs.registry.columns:
        flags = inputs.registry.groupBy("entity").agg(F.max("holds_funds").alias("holds_funds"))
        terms = terms.join(flags, "entity", "left")
    return reconcile_fees(terms, fees.withColumnRenamed("src", "entity"), "entity").drop("holds_funds")


def measured_funds(
    inputs: Inputs, settings: Settings, series: DataFrame, benchmark: Column, reference: Column, latest: dt.date
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(funds with every metric, funnel, series of the eligible funds).

    `series` is the panel of the measured window, `benchmark` what the benchmark made of it, `reference` the date
    the window ends on; the last two may depend on the entity. Nothing is dated after `latest`.
    """
    assert_unique(inputs.registry, ["entity"])
    terms = terms_in_force(inputs, settings, series, latest)
    universe, funnel = build_universe(
        inputs.registry, summarise_series(series, latest), terms,
        settings.filters.scaled_to(settings.months), inputs.holders,
    )
    universe = materialise(universe, "universe")
    eligible_series = series.join(universe.select("entity"), "entity", "left_semi")
    panel = metric_panel(eligible_series, benchmark, periods=settings.periods)
    funds = without_overlap(universe, panel, ["entity"]).join(panel, "entity")
    long_term = F.col("long_term")
    funds = funds.withColumns(
        {
            "size": log_size(F.col("average_assets")),
            "track_record": track_record(F.col("constituted"), F.col("first_date"), reference),
            "tax_efficiency": tax_efficiency(F.col("name"), F.col("grp"), long_term),
            "tax_regime": tax_regime(F.col("name"), F.col("grp"), long_term),
        }
    )
    return funds, funnel, eligible_series


@dataclass(frozen=True)
class Lists:
    """What the pools of a ranking come to."""

    scored: DataFrame
    weights: DataFrame
    found: Twins
    listed: DataFrame
    displaced: DataFrame
    struck: DataFrame


def listed_pools(
    pools: DataFrame, profiles: Sequence[Profile], series: DataFrame, rates: DataFrame, settings: Settings,
    entity_number: Callable[[Column], Column] = entity_code, profile_number: Callable[[Column], Column] = entity_code,
    calendars: tuple[str, ...] = (), part: Callable[[Column], Column] = lambda entity: F.lit(0),
) -> Lists:
    """Score stored pools, draw their stability, and walk each profile's list.

    The scored pools, the twins by class and the histories are stored on the way. Each is read several
    times after it, and each is smaller than the panel. `entity_number` and `profile_number` are what the draws
    depend on; `calendars` names columns of the series that part it by calendar, and `part` numbers these calendars by entity.
    """
    chosen, resampling = settings.selection, settings.resampling
    metrics = metrics_of(profiles)
    scored, weights = score_profiles(pools, profiles, settings.directions, settings.scoring)
    scored = materialise(scored, "scored")

    members = pools.select("entity", "manager").distinct()
    returns = pool_returns(series, members, by=calendars)
    twins = twin_classes(returns, chosen.max_tracking_difference, chosen.min_overlap, settings.periods)
    histories = materialise(aligned_returns(series.join(members.select("entity"), "entity", "left_semi"), rates), "histories")
    appearances = stability(
        scored, histories, weights, metrics, settings.directions, twins, resampling, chosen.top_n, profile_number, entity_number, part
    )
    ordered = scored.join(appearances, ["profile", "entity"])
    gated = with_gates(ordered, chosen.max_annual_cost, chosen.declared_trusted_above, chosen.performance_floor)
    gated = gated.withColumn(
        "ord_key",
        F.struct(
            (-F.col("appearance_rate")).alias("a"), (-F.round("score", 9)).alias("s"), F.col("entity").alias("e")
        ),
    )
    gated = materialise(gated, "gated")
    picks, over, struck = gated_selection(
        gated, ["profile"], "ord_key", twins, chosen.top_n, chosen.comparison_size, settings.prefix
    )
    listed = picks.join(gated, ["profile", "entity"]).drop("ord_key")
    return Lists(gated, weights, twins, listed, over, struck.drop("ord_key"))


def rank(inputs: Inputs, settings: Settings, reference: dt.date) -> Ranking:
    """Rank every profile as of one date, using nothing published after it."""
    start = window_start_date(reference, settings.months)
    series = inputs.panel.filter(F.col("ts").between(F.lit(start), F.lit(reference)))
    benchmark = benchmark_over(inputs.rates, start, reference).scalar()
    funds, funnel, series = measured_funds(inputs, settings, series, benchmark, F.lit(reference), reference)
    if settings.on_deviation == "raise":
        raise_if_off(compare_funnel(funnel, settings.expected_funnel, settings.funnel_tolerance))
    pools = materialise(profile_pools(funds, settings.profiles), "pools")
    lists = listed_pools(pools, settings.profiles, series, inputs.rates, settings)
    return Ranking(
        funds, funnel, lists.scored, lists.weights, lists.found, lists.listed, lists.displaced, lists.struck,
        manager_share(pools), start,
    )
