"""Ratios and scalings that give NULL, not an error, where they are undefined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def min_max(x: Column, low: Column, high: Column) -> Column:
    """(x - low) / (high - low); NULL when all values are equal."""
    return F.try_divide(x - low, high - low)


def log_shade(x: Column, low: Column, high: Column) -> Column:
    """Position of x between low and high on a log scale; NULL for x <= 0."""
    return F.when(x > 0, F.try_divide(F.ln(x) - F.ln(low), F.ln(high) - F.ln(low)))
