"""Exact means, ratios and shares: money and scores stay decimal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for sums over a trillion rows; their quotient keeps ten decimals
# or more, so rounding it to one or two places does not round twice.
_AMOUNT = "decimal(28,2)"
_COUNT = "decimal(18,0)"


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator`` per ``denominator``, a count; NULL over zero."""
    return F.try_divide(numerator.cast(_AMOUNT), denominator.cast(_COUNT))


def mean(values: Column | str, places: int) -> Column:
    """Mean of an integer or money column, rounded half away from zero."""
    return F.round(ratio(F.sum(values), F.count(values)), places)


def percent(part: Column, whole: Column, places: int) -> Column:
    """``part`` as a percentage of ``whole``, rounded half away from zero."""
    hundredfold = part.cast(_AMOUNT) * F.lit(100).cast("decimal(3,0)")
    return F.round(F.try_divide(hundredfold.cast(_AMOUNT), whole.cast(_AMOUNT)), places)
