"""Rows without, or with, a partner in another table."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import dates
from stallbook.sources.shared import pinned

METHODS = ("not_exists", "not_in", "left_null")


def distinct_keys(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """The distinct non-NULL values of ``key``.

    Partial aggregation collapses a hot key inside each map task, so it never
    travels as more than one row per task.
    """
    return df.select(F.col(key).alias(name or key)).where(F.col(name or key).isNotNull()).distinct()


def unmatched(parents: DataFrame, children: DataFrame, key: str,
              child_key: str | None = None, method: str = "not_exists") -> DataFrame:
    """Parents whose ``key`` occurs in no child.

    ``not_exists`` and ``left_null`` keep parents with a NULL key. ``not_in``
    follows SQL: a NULL among the children leaves nothing, no children at all
    leave every parent. Spark itself answers ``NOT IN`` only by broadcasting
    all children, so here an ordinary anti-join runs behind that test.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; choose one of {METHODS}")
    child_key = child_key or key
    if method == "left_null":
        partners = distinct_keys(children, child_key, "_partner")
        return (parents.join(partners, F.col(key) == F.col("_partner"), "left")
                .where(F.col("_partner").isNull()).drop("_partner"))
    alone = parents.join(distinct_keys(children, child_key, key), key, "left_anti").select(*parents.columns)
    if method == "not_exists":
        return alone
    rows, keys = F.count(F.lit(1)), F.count(child_key)
    found = children.agg(F.struct((rows == 0).alias("nothing"), (rows == keys).alias("no_nulls"))).scalar()
    return alone.where(found["nothing"] | (found["no_nulls"] & F.col(key).isNotNull()))


def orphans(children: DataFrame, key: str, parents: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Child key values that no parent has, with their row counts.

    Children are counted per key before the join, so a hot key is one row in
    it. A NULL key refers to nothing and is no orphan.
    """
    counted = (children.where(F.col(key).isNotNull())
               .groupBy(key).agg(F.count(F.lit(1)).alias("rows")))
    return counted.join(distinct_keys(parents, parent_key or key, key), key, "left_anti")


_BITS = 32_768          # of one of Spark's bitmaps
BITMAP_BYTES = 16 << 20  # that one task may hold


def orphans_by_bitmap(children: DataFrame, key: str, parents: DataFrame, parent_key: str | None = None,
                      most_bytes: int = BITMAP_BYTES) -> DataFrame:
    """As ``orphans``, for children that refer to a compact range of whole numbers.

    Each map task turns the keys it sees into bitmaps of 32,768 numbers, so that at most an eighth of a byte per
    number in the parents' range leaves it, however many children it reads. The children's bitmaps less the parents'
    are the orphan keys; only rows with one of them are looked at again. Keys may be whole numbers or text; text that
    isn't the plain form of one, numbers outside the parents' range, and all keys if that range would fill more than
    ``most_bytes`` take the way of ``orphans``.
    """
    parent_key = parent_key or key

    def number(column: str) -> Column:
        whole = F.col(column).try_cast("bigint")
        return F.when(whole.cast("string") == F.col(column).cast("string"), whole)

    numbered = children.where(F.col(key).isNotNull()).withColumn("_number", number(key))
    known = parents.select(number(parent_key).alias("_number")).where(F.col("_number").isNotNull())
    low, high = known.agg(F.min("_number"), F.max("_number")).first()
    if low is None or (high - low) // 8 + _BITS // 8 > most_bytes:
        return orphans(children, key, parents, parent_key)

    def bitmaps(df: DataFrame, side: str) -> DataFrame:
        place = F.col("_number") - F.lit(low) + 1
        inside = df.where(F.col("_number").between(low, high)).select(
            F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_bit"))
        return inside.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias(side))

    both = bitmaps(numbered, "_child").join(bitmaps(known, "_parent"), "_bucket", "left")

    def lost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, child, parent in zip(*(batch.column(i).to_pylist() for i in range(3))):
                bits = np.frombuffer(child, np.uint8)
                if parent is not None:
                    bits = bits & ~np.frombuffer(parent, np.uint8)
                places = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
                if len(places):
                    yield pa.RecordBatch.from_arrays([pa.array((bucket - 1) * _BITS + places + low)], ["_lost"])

    # Written down first: Spark then sees how few there are, and need not move the children to join them.
    missing = pinned(both.select("_bucket", "_child", "_parent").mapInArrow(lost, "_lost bigint"))
    inside = F.col("_number").between(low, high)
    found = (numbered.where(inside).join(missing, F.col("_number") == F.col("_lost"), "left_semi")
             .groupBy(key).agg(F.count(F.lit(1)).alias("rows")))
    others = orphans(numbered.where(F.col("_number").isNull() | ~inside).drop("_number"), key, parents, parent_key)
    return found.unionByName(others)


def without_follower(df: DataFrame, others: DataFrame, key: str, at: str, days: int,
                     other_key: str | None = None, other_at: str | None = None) -> DataFrame:
    """Rows of ``df`` after whose ``at`` no row of ``others`` with the same key comes within ``days``.

    Time is cut into bins of ``days``. The window after a moment reaches into its own bin and the next: it holds a row
    if the latest of its own bin is later than the moment, or the earliest of the next bin is not beyond the window.
    So ``others`` shrinks, already in the map tasks, to one row per key and bin, and a hot key is dealt out by bins.
    Rows with a NULL key or moment have no follower; those of ``others`` follow nothing.
    """
    def bin_of(column: str) -> Column:
        return F.floor(F.date_diff(F.to_date(column), F.lit("1970-01-01").cast("date")) / days)

    other_key, other_at = other_key or key, other_at or at
    spans = (others.where(F.col(other_key).isNotNull() & F.col(other_at).isNotNull())
             .groupBy(F.col(other_key).alias("_key"), bin_of(other_at).alias("_bin"))
             .agg(F.min(other_at).alias("_earliest"), F.max(other_at).alias("_latest")))
    moments = df.select(F.col(key).alias("_who"), F.col(at).alias("_from")).where("_who IS NOT NULL AND _from IS NOT NULL")
    reached = moments.distinct().withColumn("_own", bin_of("_from")).withColumn(
        "_bin", F.explode(F.array(F.col("_own"), F.col("_own") + 1)))
    end = dates.shift("_from", timedelta(days=days))
    within = F.when(reached["_bin"] == F.col("_own"), F.col("_latest") > F.col("_from")).otherwise(F.col("_earliest") <= end)
    followed = reached.join(spans, (F.col("_who") == F.col("_key")) & (reached["_bin"] == spans["_bin"]) & within, "left_semi")
    return df.join(followed.select("_who", "_from").distinct(),
                   (F.col(key) == F.col("_who")) & (F.col(at) == F.col("_from")), "left_anti")


def with_partner(df: DataFrame, others: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose ``key`` occurs in ``others`` (EXISTS)."""
    return df.join(distinct_keys(others, other_key or key, key), key, "left_semi").select(*df.columns)


def lookup_with_fallback(df: DataFrame, lookup: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Translate ``key`` through ``lookup``, keeping ``key`` where it has no entry.

    A left join: no row is lost for want of a translation, and Spark decides by
    the lookup's size whether to broadcast it.
    """
    out = out or value
    entries = lookup.select(F.col(key).alias("_entry"), F.col(value).alias("_value"))
    return (df.join(entries, F.col(key) == F.col("_entry"), "left")
            .withColumn(out, F.coalesce("_value", key))
            .drop("_entry", "_value"))


def mean_point(lookup: DataFrame, key: str, lat: str, lng: str) -> DataFrame:
    """One mean coordinate per key, so that joining it multiplies no rows."""
    return lookup.groupBy(key).agg(F.avg(lat).alias(lat), F.avg(lng).alias(lng),
                                   F.count(F.lit(1)).alias("points"))


def with_coordinates(df: DataFrame, key: str, geolocation: DataFrame,
                     geo_key: str = "geolocation_zip_code_prefix",
                     lat: str = "geolocation_lat", lng: str = "geolocation_lng") -> DataFrame:
    """``df`` with the mean coordinate of its zip; NULL where none is known."""
    points = mean_point(geolocation, geo_key, lat, lng).withColumnRenamed(geo_key, "_zip")
    return df.join(points, F.col(key) == F.col("_zip"), "left").drop("_zip")
