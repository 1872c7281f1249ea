"""Rounding that does not depend on binary floating point or on the order of summation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = T.DecimalType(38, 0)


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator / denominator`` rounded half away from zero to ``digits`` places, as a double.

    Both arguments are whole numbers and the denominator is positive; null when it is zero. The rounding is done
    by integer division, so ties always go the same way. Longs stay longs, which is fast; pass ``WHOLE`` decimals where
    ``2 * 10^digits * numerator`` could leave the range of a long (Spark raises an error in that case).
    """
    below = F.when(denominator != 0, denominator)
    steps = F.call_function("div", F.abs(numerator) * F.lit(2 * 10**digits) + below, below * 2)
    signed = F.when(numerator < 0, -steps).otherwise(steps)
    return signed.cast("double") / F.lit(float(10**digits))


def cents(money: Column) -> Column:
    """A single amount as a whole number of cents."""
    return (money * 100).cast("long")


def average_money(total: Column, count: Column) -> Column:
    """Average in money rounded to whole cents, as a double. Totals may exceed a long in cents."""
    return rounded_ratio((total * 100).cast(WHOLE), count.cast(WHOLE), 0) / F.lit(100.0)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal, from two counts."""
    return rounded_ratio(part.cast("long") * 100, whole.cast("long"), 1)
