"""Scalar statistics."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def stddev_over(value: Column, window: WindowSpec, rows: int) -> Column:
    """Sample deviation over a window of at most ``rows`` rows, from exact sums where all values are whole.

    Running means leave an error in the last digit, so that a score of exactly 2 may come out
    above or below. Whole numbers up to 3e9 / ``rows`` are added up in 64 bits without any; for
    others it is ``stddev_samp``.
    """
    limit = 3_000_000_000 // rows
    number = value.try_cast("bigint")
    whole = F.when(value.between(-limit, limit) & (number == value), number)
    n, total, squares = (x.over(window) for x in (F.count(value), F.sum(whole), F.sum(whole * whole)))
    exact = F.sqrt((n * squares - total * total) / (n * (n - 1)))
    return F.when((n > 1) & (F.count(whole).over(window) == n), exact).otherwise(F.stddev_samp(value).over(window))


def zscore(value: Column, mean: Column, stddev: Column) -> Column:
    """Distance from the mean in standard deviations; 0 when there is no spread."""
    return F.when(stddev > 0, (value - mean) / stddev).otherwise(F.lit(0.0))


def exceeds(threshold: float, *scores: Column) -> Column:
    """True when any score lies further than ``threshold`` from zero."""
    hit = F.lit(False)
    for score in scores:
        hit = hit | F.coalesce(F.abs(score) > F.lit(threshold), F.lit(False))
    return hit


def percent_change(new: Column, old: Column) -> Column:
    """Change in percent; NULL when there is no base to divide by."""
    return F.try_divide(new - old, old) * 100
