"""Parameters of a ranking, as plain frozen dataclasses."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(int(value))


def literal_table(spark: SparkSession, names: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    """A table of parameters as SQL values: it is part of the plan and needs no job."""
    values = ", ".join("(" + ", ".join(map(_sql_literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


@dataclass(frozen=True)
class Eligibility:
    """Who may buy, and on what terms. None means no limit, which is not a limit of 0."""

    target_investor: Sequence[str] | None = None
    max_minimum_investment: float | None = None
    max_redemption_days: int | None = None


@dataclass(frozen=True)
class Profile:
    profile_id: str
    weights: Mapping[str, int]
    jitter: Mapping[str, int] = field(default_factory=dict)
    eligibility: Eligibility = Eligibility()
    label: str = ""

    def __post_init__(self) -> None:
        if sum(self.weights.values()) != 100:
            raise ValueError(f"weights of {self.profile_id} must sum to 100")


@dataclass(frozen=True)
class Filters:
    """The eligibility rules of the universe."""

    classification: Sequence[str]
    status: Sequence[str]
    condominium: Sequence[str]
    exclude_exclusive: bool = True
    exclude_name_markers: Sequence[str] = ()
    min_observations: int = 200
    min_assets: float = 10_000_000.0
    min_holders: int = 500
    require_fee_and_redemption: bool = True

    def scaled_to(self, months: int) -> Filters:
        """The observation floor is declared for twelve months; scale it to the window."""
        values = {**self.__dict__, "min_observations": round(self.min_observations * months / 12)}
        return Filters(**values)


@dataclass(frozen=True)
class Scoring:
    lower: float = 0.01
    upper: float = 0.99
    min_dispersion: float = 0.05
    min_group: int = 20


@dataclass(frozen=True)
class Selection:
    max_tracking_difference: float = 0.001
    min_overlap: int = 60
    performance_floor: float = 0.20
    max_annual_cost: float = 0.01
    declared_trusted_above: float = 0.0005
    top_n: int = 5
    comparison_size: int = 10


@dataclass(frozen=True)
class Resampling:
    draws: int = 1000
    block: int = 21
    seed: int = 20250101
    periods: int = 252


@dataclass(frozen=True)
class Backtest:
    cut_dates: Sequence[dt.date]
    end_date: dt.date
    portfolios: int = 1000
    seed: int = 20250630
    success_percentile: float = 60.0
    success_min_dates: int = 2
    tolerance_days: int = 30


# Direction of each metric: which end of it is good.
DIRECTIONS = {
    "excess_return": "high",
    "return_per_risk": "high",
    "volatility": "low",
    "max_drawdown": "high",
    "negative_days": "low",
    "admin_fee": "low",
    "redemption_days": "low",
    "size": "high",
    "flow_stability": "high",
    "track_record": "high",
    "tax_efficiency": "high",
}
# Scores the deepest fall best, as published rankings to be compared with do.
PARITY_DIRECTIONS = {**DIRECTIONS, "max_drawdown": "low"}


def weights_table(spark: SparkSession, profiles: Sequence[Profile]) -> DataFrame:
    """(profile, metric, ord, weight, jitter): a row per weighted metric of a profile."""
    rows = [
        (p.profile_id, metric, place, weight, int(p.jitter.get(metric, 0)))
        for p in profiles
        for place, (metric, weight) in enumerate(p.weights.items())
    ]
    return literal_table(spark, ["profile", "metric", "ord", "weight", "jitter"], rows)


def metrics_of(profiles: Sequence[Profile]) -> list[str]:
    """Every metric some profile weighs, in first-named order."""
    return list(dict.fromkeys(m for p in profiles for m in p.weights))
