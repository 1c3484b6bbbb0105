"""Rounding rules that change results if they are mixed up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def saturate(c: Column, low: int, high: int) -> Column:
    """Half away from zero, then cut to low..high, as a cast to a whole-number pixel type does; NaN gives 0."""
    return F.when(F.isnan(c), 0).otherwise(F.least(F.lit(high), F.greatest(F.lit(low), F.round(c, 0)))).cast("int")


def half_even(c: Column) -> Column:
    return F.bround(c, 0).cast("int")


def half_up(c: Column) -> Column:
    """floor(x + 0.5)."""
    return F.floor(c + 0.5).cast("int")


def truncate(c: Column) -> Column:
    """Towards zero."""
    return c.cast("int")
