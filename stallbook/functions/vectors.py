"""Distances between ``array<float>`` columns, computed in double.

NULL vectors give NULL. Vectors of unequal length give NULL as well, because
``zip_with`` pads the shorter one with NULLs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "l2", "inner_product")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine_distance(a: Column, b: Column, length_of_b: Column | None = None, length_of_a: Column | None = None) -> Column:
    """``1 - cos``; NULL when either vector has zero length.

    ``length_of_b`` spares working out the same norm for every row, ``length_of_a`` is a stored one.
    """
    lengths = (norm(a) if length_of_a is None else length_of_a) * (norm(b) if length_of_b is None else length_of_b)
    return F.lit(1.0) - F.try_divide(dot(a, b), lengths)


def l2_distance(a: Column, b: Column) -> Column:
    def squared(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.sqrt(_total(F.zip_with(a, b, squared)))


def negative_inner_product(a: Column, b: Column) -> Column:
    """Negated so that, like a distance, smaller is closer."""
    return -dot(a, b)


def distance(metric: str, a: Column, b: Column, length_of_b: Column | None = None,
             length_of_a: Column | None = None) -> Column:
    match metric:
        case "cosine":
            return cosine_distance(a, b, length_of_b, length_of_a)
        case "l2":
            return l2_distance(a, b)
        case "inner_product":
            return negative_inner_product(a, b)
    raise ValueError(f"unknown metric {metric!r}; choose one of {METRICS}")


def stored_precision(vector: Column | str, places: int = 6) -> Column:
    """The vector as it is stored: each component rounded to ``places`` decimals."""
    return F.transform(vector, lambda x: F.round(x.cast("double"), places).cast("float"))
