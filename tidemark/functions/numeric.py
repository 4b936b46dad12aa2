"""Rounding, flags and clipping with the null rules the reports rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(c: Column, digits: int) -> Column:
    """SQL-report rounding: scaled, half away from zero, returned as double.

    A value with no such digits left in a double (2^53 units and more) stays as it is.
    """
    factor = float(10**digits)
    x = c.cast("double")
    # Integer arithmetic for the sign, so that small negatives give 0 and not -0.
    rounded = F.floor(F.abs(x) * factor + 0.5) * F.sign(x).cast("int") / F.lit(factor)
    return F.when(F.abs(x) * factor >= float(2**53), x).otherwise(rounded)


def round_half_even(c: Column, digits: int) -> Column:
    """Feature rounding: scaled, ties to even."""
    factor = float(10**digits)
    return F.rint(c.cast("double") * factor) / F.lit(factor)


def flag(condition: Column) -> Column:
    """0/1 integer; a missing operand counts as false."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def clip(c: Column, lower=None, upper=None) -> Column:
    """Bound a value on either side; a missing value stays missing."""
    bounded = c
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, F.lit(upper))
    return F.when(c.isNotNull(), bounded)


def mean(c: Column, where: Column | None = None) -> Column:
    """Average as sum over count, so that decimal input is summed exactly."""
    picked = c if where is None else F.when(where, c)
    return F.try_divide(F.sum(picked).cast("double"), F.count(picked).cast("double"))


def total(c: Column, where: Column | None = None) -> Column:
    """Sum as double; decimal input is added up exactly before the cast."""
    picked = c if where is None else F.when(where, c)
    return F.sum(picked).cast("double")


def percent(c: Column, digits: int | None = None, where: Column | None = None) -> Column:
    """Mean of a 0/1 column in percent."""
    value = mean(c, where) * 100
    return value if digits is None else round_half_away(value, digits)


def rows() -> Column:
    return F.count(F.lit(1))
