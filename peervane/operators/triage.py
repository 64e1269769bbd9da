"""Every row gets a fate: clean, quarantined with a reason, future, or duplicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peervane.functions.keys import check_digits_match, key_problem

CLEAN, QUARANTINED, FUTURE, DUPLICATE = "clean", "quarantined", "future", "deduplicated"


class TooMuchQuarantinedError(RuntimeError):
    """So much input was unusable that a ranking of the rest would mislead."""


class ContractError(RuntimeError):
    """Rows the triage let through break the declared contract."""


def rejection_reason(key: Column, ts: Column, price: Column, assets: Column) -> Column:
    """The first thing wrong with a row, or null."""
    return F.coalesce(
        key_problem(key),
        F.when(ts.isNull(), "no readable date")
        .when(price.isNull(), "no price")
        .when(price <= 0, "price at or below zero")
        .when(assets < 0, "assets below zero"),
    )


def triage(
    frame: DataFrame, keys: Sequence[str], ts: str, reason: Column, reference, order: Sequence[Column]
) -> DataFrame:
    """One row per natural key with `disposition`, `reason` and `copies`, the rows received under the key.

    Deduplication comes first and keeps the last row, then rows after the
    reference date are set aside, then the reason is sought. Copies are counted by the aggregate that
    picks the last of them, with partial results on the map side: the input is read once, and a hot key is one row per task.
    """
    keys = list(keys)
    last = F.max_by(F.struct(*frame.columns), F.struct(*order, F.struct(*frame.columns)))
    kept = frame.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        last.alias("_last"), F.count(F.lit(1)).alias("copies")
    ).select("_last.*", "copies")
    late = F.coalesce(F.col(ts) > F.lit(reference), F.lit(False))
    judged = kept.withColumn("reason", F.when(~late, reason))
    return judged.withColumn(
        "disposition",
        F.when(late, FUTURE).when(F.col("reason").isNotNull(), QUARANTINED).otherwise(CLEAN),
    )


def clean_rows(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("disposition") == CLEAN).drop("disposition", "reason", "copies")


def quarantine(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("disposition") == QUARANTINED).drop("disposition", "copies")


def _totals(judged: DataFrame) -> DataFrame:
    """One row of counts, from the triaged rows alone."""
    return judged.agg(
        *[F.count_if(F.col("disposition") == d).alias(d) for d in (CLEAN, QUARANTINED, FUTURE)],
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias(DUPLICATE),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("received"),
    )


def accounting(judged: DataFrame) -> DataFrame:
    """(disposition, n_rows) for the four fates; they add up to the rows received."""
    return _totals(judged).unpivot([], [CLEAN, QUARANTINED, FUTURE, DUPLICATE], "disposition", "n_rows")


def quarantine_share(judged: DataFrame) -> DataFrame:
    """One row: rows received, rows quarantined, and their share."""
    share = F.when(F.col("received") > 0, F.col(QUARANTINED) / F.col("received")).otherwise(0.0)
    return _totals(judged).select("received", QUARANTINED, share.alias("share"))


def assert_quarantine_within(judged: DataFrame, limit: float) -> float:
    row = quarantine_share(judged).first()
    if row["share"] > limit:
        raise TooMuchQuarantinedError(
            f"{row['quarantined']} of {row['received']} rows quarantined, above {limit:.0%}"
        )
    return row["share"]


def contract_breaches(
    clean: DataFrame, key: str, ts: str, price: str, assets: str, holders: str
) -> DataFrame:
    """One row counting breaches of each declared rule, in one pass."""
    return clean.agg(
        F.count_if(~F.coalesce(F.col(key).rlike(r"^[0-9]{14}$"), F.lit(False))).alias("key"),
        F.count_if(F.col(ts).isNull()).alias("date"),
        F.count_if(~F.coalesce(F.col(price) > 0, F.lit(False))).alias("price"),
        F.count_if(F.col(assets) < 0).alias("assets"),
        F.count_if(F.col(holders) < 0).alias("holders"),
    )


def assert_contract(clean: DataFrame, key: str, ts: str, price: str, assets: str, holders: str) -> None:
    broken = {
        rule: n
        for rule, n in contract_breaches(clean, key, ts, price, assets, holders).first().asDict().items()
        if n
    }
    if broken:
        raise ContractError(f"clean rows break the contract: {broken}")


def valid_keys(frame: DataFrame, key: str) -> DataFrame:
    """Each distinct key with whether its check digits match."""
    return frame.select(key).distinct().withColumn("valid", check_digits_match(F.col(key)))
