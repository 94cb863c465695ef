"""Numeric column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(c: Column | str, digits: int) -> Column:
    """Round to ``digits`` decimals, ties to the even neighbour (``round`` is half-up)."""
    c = F.col(c) if isinstance(c, str) else c
    if digits == 0:
        return F.rint(c)
    scale = F.lit(float(10**digits))
    return F.rint(c * scale) / scale


def clip(c: Column | str, low: float, high: float) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null, not an error, for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_half_up(c: Column) -> Column:
    """Round to an integer the way browsers do: .5 goes up, also below zero."""
    return F.floor(c + F.lit(0.5)).cast("long")
