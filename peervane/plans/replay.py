"""The ranking rebuilt at earlier dates and scored on what followed, all dates in one plan.

A cut date is not a loop but part of the keys: a price, a filing or a registry row is repeated for each cut it is visible at, under a
key made of its entity and the number of the cut. The panel is scanned once, and every later step ranks, draws and
walks all cuts together, in the order of the entities and with the draws that a ranking of one date has.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peervane.functions.dates import window_start_date
from peervane.functions.uniform import entity_code
from peervane.operators.backtest import (
    benchmark_returns,
    discontinued,
    evaluate,
    forward_returns,
    verdict,
)
from peervane.operators.peers import profile_pools
from peervane.operators.series import benchmark_over
from peervane.params import Backtest
from peervane.plans.ranking import Inputs, Lists, Settings, listed_pools, measured_funds
from peervane.session import materialise

MARK = "\u0001"


@dataclass(frozen=True)
class CutKeys:
    """Keys of (entity, cut) that sort as the entities do within a cut: whole numbers stay whole numbers, the rest become strings."""

    cuts: Sequence[dt.date]
    whole: bool

    @classmethod
    def of(cls, cuts: Sequence[dt.date], kind: T.DataType) -> CutKeys:
        return cls(tuple(cuts), isinstance(kind, T.IntegralType))

    @property
    def bits(self) -> int:
        return max(1, (len(self.cuts) - 1).bit_length())

    def joined(self, entity: Column, cut: Column) -> Column:
        if self.whole:
            return F.shiftleft(entity.cast("bigint"), self.bits) + cut
        return F.concat(entity.cast("string"), F.lit(MARK), cut.cast("string"))

    def entity(self, key: Column) -> Column:
        return F.shiftright(key, self.bits) if self.whole else F.substring_index(key, MARK, 1)

    def cut(self, key: Column) -> Column:
        if self.whole:
            return key.bitwiseAND(F.lit((1 << self.bits) - 1)).cast("int")
        return F.substring_index(key, MARK, -1).cast("int")

    def at(self, key: Column, values: Sequence[Column]) -> Column:
        """The value of the key's cut."""
        return F.element_at(F.array(*values), self.cut(key) + 1)

    def repeated(self, frame: DataFrame, columns: Sequence[str], visible: Column | None = None) -> DataFrame:
        """Rows once for each cut they are visible at, `columns` keyed by it. `visible` is an array of flags by cut."""
        numbers = F.array(*[F.lit(n) for n in range(len(self.cuts))])
        if visible is not None:
            numbers = F.filter(numbers, lambda n: F.element_at(visible, n + 1))
        keyed = frame.select("*", F.explode(numbers).alias("_cut"))
        return keyed.withColumns({c: self.joined(F.col(c), F.col("_cut")) for c in columns})


def by_cut(inputs: Inputs, keys: CutKeys, months: int) -> Inputs:
    """The inputs as every cut sees them: prices of its window, filings up to it, and all that has no date."""
    words = replace(keys, whole=False)
    ts = F.col("ts")
    filed = F.array(*[ts <= F.lit(cut) for cut in keys.cuts])
    priced = F.array(*[ts.between(F.lit(window_start_date(cut, months)), F.lit(cut)) for cut in keys.cuts])
    every = lambda frame, columns: None if frame is None else keys.repeated(frame, columns).drop("_cut")
    fallback = inputs.fallback_terms
    registry = every(inputs.registry, ["entity"])
    return Inputs(
        panel=keys.repeated(inputs.panel, ["entity"], priced),
        registry=registry.withColumn("manager", words.joined(F.col("manager"), keys.cut(F.col("entity")))),
        primary_terms=keys.repeated(inputs.primary_terms, ["entity"], filed).drop("_cut"),
        fallback_terms=keys.repeated(fallback, ["entity"], filed).drop("_cut") if "ts" in fallback.columns else every(fallback, ["entity"]),
        rates=inputs.rates,
        holdings=every(inputs.holdings, ["src", "dst"]),
        holders=every(inputs.holders, ["entity"]),
    )


def rankings(inputs: Inputs, settings: Settings, cuts: Sequence[dt.date]) -> tuple[DataFrame, DataFrame]:
    """(listed, scored) of every cut: (cut_date, profile, entity, ..) as `rank` gives them for each date alone."""
    keys = CutKeys.of(cuts, inputs.registry.schema["entity"].dataType)
    words = replace(keys, whole=False)
    seen = by_cut(inputs, keys, settings.months)
    entity, profile = F.col("entity"), F.col("profile")
    earned = [benchmark_over(inputs.rates, window_start_date(cut, settings.months), cut).scalar() for cut in cuts]
    dates = [F.lit(cut) for cut in cuts]
    # The cut goes along in the series only to keep calendars apart.
    funds, _, series = measured_funds(
        seen, settings, seen.panel, keys.at(entity, earned), keys.at(entity, dates), max(cuts)
    )
    pools = profile_pools(funds, settings.profiles).withColumn("profile", words.joined(profile, keys.cut(entity)))
    profiles = [replace(p, profile_id=f"{p.profile_id}{MARK}{n}") for n in range(len(cuts)) for p in settings.profiles]

    # Draws depend on the entity and the profile, and not on the cut.
    lists = listed_pools(
        materialise(pools, "pools"), profiles, series, inputs.rates, settings,
        entity_number=lambda key: entity_code(keys.entity(key)), profile_number=lambda key: entity_code(words.entity(key)),
        calendars=("_cut",), part=keys.cut,
    )

    def dated(frame: DataFrame) -> DataFrame:
        return frame.withColumn("cut_date", keys.at(entity, dates)).withColumns(
            {"entity": keys.entity(entity), "profile": words.entity(profile), "manager": words.entity(F.col("manager"))}
        )

    return dated(lists.listed), dated(lists.scored)


def replay(inputs: Inputs, settings: Settings, rules: Backtest) -> tuple[DataFrame, DataFrame]:
    """(outcomes, verdict): all cuts ranked in one plan and measured in another, over the whole panel and not the survivors."""
    listed, scored = rankings(inputs, settings, rules.cut_dates)
    chosen = materialise(listed.filter("delivered").select("cut_date", "profile", "entity"), "selected")
    outcomes = materialise(
        evaluate(
            chosen, scored.select("cut_date", "profile", "entity", "fee"), forward_returns(inputs.panel, rules),
            benchmark_returns(inputs.rates, rules), discontinued(inputs.panel, rules), rules,
        ),
        "outcomes",
    )
    return outcomes, verdict(outcomes, rules)
