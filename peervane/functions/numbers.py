"""Numeric expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(raw: Column) -> Column:
    return raw.try_cast("double")


def to_long(raw: Column) -> Column:
    """Text to a whole number; anything else, `1.5` included, becomes null."""
    return raw.try_cast("bigint")


def percent_to_fraction(raw: Column) -> Column:
    return to_double(raw) / F.lit(100.0)


def clip(value: Column, low: Column, high: Column) -> Column:
    """Bound a value; a null value stays null and a null bound binds nothing."""
    return F.when(value.isNotNull(), F.greatest(low, F.least(high, value)))


def max_ignoring_null(*values: Column) -> Column:
    return F.greatest(*values)


def log_size(assets: Column) -> Column:
    return F.log1p(assets)


def finite_or_null(value: Column) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def usable_price(price: Column) -> Column:
    """A price a return can be taken on: present, finite and above zero."""
    return (
        price.isNotNull() & ~F.isnan(price) & (price > 0) & (price != F.lit(float("inf")))
    )


def excess_return(total: Column, benchmark: Column) -> Column:
    return total - benchmark


def return_per_risk(total: Column, benchmark: Column, volatility: Column) -> Column:
    """Excess return per unit of volatility; a series that never moved gets null."""
    return F.when(volatility > 0, (total - benchmark) / volatility)


def annual_fee(retained: Column, years: Column) -> Column:
    """The yearly rate that leaves `retained` of the growth after `years`."""
    return F.lit(1.0) - F.pow(retained, F.lit(1.0) / years)


def redemption_days(conversion: Column, payment: Column, unit: Column | None) -> Column:
    """Calendar days from asking to receiving; business days are stretched by 7/5."""
    days = F.coalesce(conversion, F.lit(0)) + F.coalesce(payment, F.lit(0))
    if unit is None:
        return days.cast("bigint")
    business = F.coalesce(F.upper(unit).contains("TEIS"), F.lit(False))
    return F.when(business, F.ceil(days * 7 / F.lit(5.0))).otherwise(days).cast("bigint")


def gate_cost(declared: Column, measured: Column, trusted_above: float) -> Column:
    """The declared fee where it is believable, else the measured one."""
    return F.when(declared > F.lit(trusted_above), declared).otherwise(
        F.coalesce(measured, declared)
    )
