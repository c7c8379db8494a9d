"""Shared measures: every rate, total and rounding rule is defined here once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, digits: int = 2) -> Column:
    """Round half away from zero on the binary value, as SQL engines with a double ROUND do.

    ``F.round(x, 2)`` works on the decimal text of the double and differs on ties such as 1.005.
    """
    scale = float(10**digits)
    return F.round(value.cast("double") * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL, not an error, on a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))


def rate_pct(numerator: Column, denominator: Column) -> Column:
    return round_to(F.lit(100.0) * numerator / F.nullif(denominator, F.lit(0)))


def pct(numerator: Column, denominator: Column) -> Column:
    """Percentage that is 0.0 on a zero denominator."""
    return F.coalesce(F.lit(100.0) * numerator / F.nullif(denominator, F.lit(0)), F.lit(0.0))


def steady(money_total: Column) -> Column:
    """A sum of doubles without the noise of its summation order, which tasks decide.

    A quotient of it that ends in exactly half a cent then rounds the same way on every run.
    """
    return round_to(money_total, 6)


def rows(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def total(flag: str, alias: str) -> Column:
    return F.sum(flag).alias(alias)


def booked_revenue() -> Column:
    """Revenue of booked rows, NULL elsewhere."""
    return F.when(F.col("booked_flag") == 1, F.col("revenue"))


def average(money: Column) -> Column:
    """Mean of an amount over its non-NULL rows, from a steady sum."""
    return ratio(steady(F.sum(money)), F.count(money))
