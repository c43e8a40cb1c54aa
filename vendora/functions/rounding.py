"""Exact ratios and date parts that do not depend on engine or session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "decimal(30,0)"


def half_up(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator / denominator`` rounded half up to ``digits``, as a double.

    Both sides are whole numbers.  The division is done on integers, so ties
    never depend on how a binary fraction happens to be stored.  A zero or
    NULL denominator gives NULL.
    """
    a = numerator.cast(WHOLE) * F.lit(10**digits)
    b = F.nullif(denominator.cast(WHOLE), F.lit(0).cast(WHOLE))
    two = F.lit(2)
    magnitude = F.call_function("div", two * F.abs(a) + F.abs(b), two * F.abs(b))
    sign = F.signum(numerator.cast("double")) * F.signum(denominator.cast("double"))
    return F.when(b.isNotNull(), magnitude.cast("double") * sign / F.lit(float(10**digits)))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` with two decimals."""
    return half_up(part.cast(WHOLE) * F.lit(100), whole, 2)


def cents(money: Column) -> Column:
    """A two-decimal amount as a whole number of cents."""
    return (money * F.lit(100)).cast(WHOLE)


def money_mean(total: Column, count: Column) -> Column:
    """Mean amount to the cent."""
    return half_up(cents(total), count, 0) / F.lit(100.0)


def hundredths(value: Column) -> Column:
    """A double that carries two decimals as a whole number of hundredths."""
    return F.round(value * F.lit(100.0)).cast("long")


def month_of(timestamp: Column) -> Column:
    """First instant of the month, without any session time zone."""
    return F.trunc(F.to_date(timestamp), "month").cast("timestamp_ntz")
