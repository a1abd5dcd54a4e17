"""Exact decimal division.

Spark's ``avg`` of a decimal(p,2) rounds to six digits before a cast rounds again, which is off by a
cent once a group is large. Dividing decimal sums keeps 18 digits, so only the final cast rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_WIDE = "decimal(20,0)"


def ratio(numerator: Column, denominator: Column, result: str) -> Column:
    """Integer / integer as an exact decimal, rounded half away from zero; NULL when the divisor is 0."""
    return (numerator.cast(_WIDE) / F.nullif(denominator.cast(_WIDE), F.lit(0).cast(_WIDE))).cast(result)


def mean_of(total: Column, count: Column, result: str) -> Column:
    """Mean from a decimal sum and a count, rounded once; NULL when nothing was counted."""
    return (total / F.nullif(count.cast(_WIDE), F.lit(0).cast(_WIDE))).cast(result)


def float_mean(total: Column, count: Column) -> Column:
    """Mean as a double from an exact sum: the same bits whatever the order of the rows."""
    return total.cast("double") / count.cast("double")
