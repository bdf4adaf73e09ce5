"""Ranges of a column that hold about equally many rows, so that ordered work can be dealt over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_cuts(df: DataFrame, column: str, ranges: int) -> list[int]:
    """At most ranges - 1 values of a long column that cut its rows, nulls apart, into ranges of about equal size.

    They are approximate quantiles, so a few values far from all others move no other value into another range.
    """
    shares = [i / ranges for i in range(1, ranges)]
    found = df.filter(F.col(column).isNotNull()).agg(F.percentile_approx(column, shares, F.lit(50 * ranges))).first()[0]
    return sorted(set(found or []))


def range_of(column: Column, cuts: list[int], low: int = 0) -> Column:
    """How many of the cuts are not above the value, by halving."""
    if not cuts:
        return F.lit(low)
    half = len(cuts) // 2
    return F.when(column < F.lit(cuts[half]), range_of(column, cuts[:half], low)).otherwise(range_of(column, cuts[half + 1 :], low + half + 1))
