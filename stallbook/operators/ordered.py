"""Running sums, ranks and top-k, safe when one group holds most rows.

A window sends each of its partitions to one task. That is right for the many
small groups and wrong for an unpartitioned rank or a group with a third of
the rows. For those, ``split_running_sum`` cuts the sorted rows into ranges,
sums inside each range, and carries the earlier ranges' totals over.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.sources.shared import pinned

def _renamed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with a ``right_`` prefix on ``columns``, to join it to its own source."""
    return df.select(*[F.col(c).alias(f"right_{c}") if c in columns else F.col(c) for c in df.columns])


def _same(columns: Sequence[str]) -> Column:
    """Equality with the ``_renamed`` side; a NULL group matches itself."""
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"right_{c}")) for c in columns])


def split_running_sum(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows of a ``by`` group up to and including this one.

    ``order`` must not tie within a group. Windows span one range, never a
    whole group; there are as many ranges as shuffle partitions. The ranges are
    pinned, because two evaluations could cut them differently.
    """
    cut = df.repartitionByRange(*[F.col(c) for c in by], *order)
    ranges = pinned(cut.withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranges.withColumn("_inside", F.sum(value).over(inside))
    # At most one row per range and group it touches: groups + ranges in all.
    totals = ranges.groupBy("_range", *by).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("_range", *by, F.sum("_total").over(before).alias("_carried"))
    place = ["_range", *by]
    total = F.col("_inside") + F.coalesce("_carried", F.lit(0))
    return (summed.join(_renamed(carried, place), _same(place), "left")
            .select(*df.columns, total.alias(out)))


def value_ranks(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """SQL ``RANK`` of each distinct ``value``, largest first, per ``by`` group.

    Works on one row per distinct value, so a crowd of equal values is a count
    and not a crowd of rows.
    """
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = split_running_sum(counts, by, [F.col(value).desc_nulls_first()], "_n", "_upto")
    return upto.select(*by, value, (F.col("_upto") - F.col("_n") + 1).alias(out))


def with_ranks(df: DataFrame, value: str, ranks: Mapping[str, Sequence[str]]) -> DataFrame:
    """``df`` with the SQL ``RANK`` of ``value``, largest first, once per entry of
    ``ranks``: the new column and the group it ranks within (none: all rows).

    ``df`` is read repeatedly: pin it first.
    """
    ranked = df
    for out, by in ranks.items():
        key = [*by, value]
        found = _renamed(value_ranks(df, by, value, out), key)
        ranked = ranked.join(found, _same(key)).select(*ranked.columns, out)
    return ranked


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, position: str = "position") -> DataFrame:
    """The first ``k`` rows of each group; ``order`` decides every tie.

    Each map task keeps its own best ``k`` per group before the shuffle, so a
    hot group arrives as ``k`` rows per task.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(position, F.row_number().over(w)).where(F.col(position) <= k)


def winners(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The rows with the largest ``value`` of each group, ties included."""
    w = Window.partitionBy(*by).orderBy(F.col(value).desc_nulls_first())
    return df.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row of each key with the latest ``order``; NULL counts as latest.

    Rows tied on ``order`` are told apart by their other columns, so the choice
    does not depend on where a row happens to lie.
    """
    rest = [c for c in df.columns if c not in (*keys, order)]
    # A maximum, not a sort: each map task keeps one row per key, and the other
    # columns are looked at only where the order ties.
    place = [part for c in (order, *rest) for part in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(f"at_{c}"))]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(order, *rest), F.struct(*place)).alias("_latest"))
    return latest.select(*keys, "_latest.*").select(*df.columns)


def sample_in_order(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The first ``limit`` rows by ``key``: the same sample every time."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(limit)
