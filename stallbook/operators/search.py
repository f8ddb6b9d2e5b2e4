"""Nearest neighbours by exact scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import vectors


def seed_vector(df: DataFrame, key: str, seed, vector: str = "embedding") -> Column:
    """The vector of the row with ``key = seed`` and its length, as a scalar subquery.

    One value whatever the size of ``df``; more than one such row is an error.
    """
    found = df.where(F.col(key) == F.lit(seed))
    return found.select(F.struct(F.col(vector).alias("vector"), vectors.norm(F.col(vector)).alias("length"))).scalar()


def with_distance(df: DataFrame, query: Column, metric: str = "cosine", vector: str = "embedding") -> DataFrame:
    """Rows that have a vector, with its distance to ``query`` (see ``seed_vector``).

    The distance is NULL when the lengths differ, or when the cosine of a
    vector of length zero is asked for.
    """
    measured = df.where(F.col(vector).isNotNull()).withColumn("_query", query)
    return (measured.withColumn("distance", vectors.distance(metric, F.col(vector), F.col("_query.vector"),
                                                             F.col("_query.length")))
            .drop("_query"))


def nearest(df: DataFrame, seed, k: int = 5, metric: str = "cosine",
            key: str = "order_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` rows closest to the row with ``key = seed``, itself included.

    Fewer when fewer rows have a distance. Every task keeps its own ``k`` best,
    so only ``k`` rows per task meet. Rows without a distance sort last and are
    left out afterwards: a filter before would work the distance out twice.
    """
    scored = with_distance(df, seed_vector(df, key, seed, vector), metric, vector)
    closest = scored.orderBy(F.col("distance").asc_nulls_last(), F.col(key).asc()).limit(k)
    return closest.where(F.col("distance").isNotNull() & ~F.isnan("distance"))
