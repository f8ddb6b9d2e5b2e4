"""Approximate statistics that add up: sketches taken as rows are written, merged without the rows.

Opt-in beside the exact reports. A batch's or version's sketches are metrics of its write (``tables.write_version``), kept
with its commit; those of any number of batches merge to the sketch of all their rows, so a report over what has
arrived so far reads no table. Sketches travel as base64 text.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.functions import dates

HLL_LOG_BUCKETS = 14    # 2^14 buckets: 16 KB at most
KLL_SIZE = 400          # of a quantile sketch

Values = Mapping[str, Mapping[str, object]]     # by table and metric, as one write observed them


def distinct_error(log_buckets: int = HLL_LOG_BUCKETS) -> float:
    """How far, as a share of the true number, an estimate lies off at most, but for one in a thousand."""
    return 3.3 * 1.04 / 2 ** (log_buckets / 2)


def rank_error(size: int = KLL_SIZE) -> float:
    """How far, as a share of the rows, a quantile's rank lies off at most, but for one in a hundred."""
    return 2.296 / size ** 0.9723


def key_label(table: str, columns: Sequence[str]) -> str:
    return f"{table}.{columns[0]}" if len(columns) == 1 else f"{table} ({', '.join(columns)})"


def distinct_metrics(candidates: Iterable[tuple[str, Sequence[str]]],
                     log_buckets: int = HLL_LOG_BUCKETS) -> dict[str, dict[str, Column]]:
    """Per table a sketch of the distinct values of each candidate key.

    As in ``profiling.key_uniqueness`` a single column counts without NULLs, and a composite key is a row value.
    """
    found: dict[str, dict[str, Column]] = {}
    for table, columns in candidates:
        if len(columns) == 1:
            value = F.col(columns[0]).cast("string")
        else:
            value = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
        found.setdefault(table, {})[key_label(table, columns)] = F.base64(F.hll_sketch_agg(value, log_buckets))
    return found


def distinct_counts(spark: SparkSession, writes: Sequence[Values],
                    candidates: Iterable[tuple[str, Sequence[str]]]) -> DataFrame:
    """(candidate_key, rows, distinct_estimate) over all ``writes`` together, from their sketches alone."""
    rows = [(key_label(table, columns), values[table]["rows"], values[table][key_label(table, columns)])
            for values in writes for table, columns in candidates]
    given = spark.createDataFrame(rows, "candidate_key string, rows long, sketch string")
    return given.groupBy("candidate_key").agg(
        F.sum("rows").alias("rows"),
        F.hll_sketch_estimate(F.hll_union_agg(F.unbase64("sketch"))).alias("distinct_estimate")).orderBy("candidate_key")


def gap_metrics(earlier: str, later: str, size: int = KLL_SIZE) -> dict[str, Column]:
    """Additive statistics of the seconds from ``earlier`` to ``later``: how many, their sum, how many are negative, and
    a sketch of their quantiles."""
    seconds = dates.seconds_between(later, earlier).cast("bigint")
    return {"gaps": F.count(seconds), "seconds": F.coalesce(F.sum(seconds), F.lit(0).cast("bigint")),
            "negative": F.count_if(seconds < 0), "quantiles": F.base64(F.kll_sketch_agg_bigint(seconds, size))}


def gap_statistics(spark: SparkSession, writes: Sequence[Mapping[str, object]]) -> DataFrame:
    """(rows, median_days, mean_days, negative) over all ``writes``, from their ``gap_metrics`` alone.

    The median is estimated within ``rank_error``; the rest is exact.
    """
    rows = [(w["gaps"], w["seconds"], w["negative"], w["quantiles"]) for w in writes]
    given = spark.createDataFrame(rows, "gaps long, seconds long, negative long, quantiles string")
    day = F.lit(86400.0)
    # An empty sketch has no quantiles and is left out.
    merged = F.kll_merge_agg_bigint(F.when(F.col("gaps") > 0, F.unbase64("quantiles")))
    total = given.agg(F.coalesce(F.sum("gaps"), F.lit(0)).alias("rows"), merged.alias("sketch"),
                      F.sum("seconds").alias("seconds"), F.coalesce(F.sum("negative"), F.lit(0)).alias("negative"))
    median = F.when(F.col("rows") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.5)))
    return total.select("rows", F.round(median / day, 4).alias("median_days"),
                        F.round(F.try_divide("seconds", "rows") / day, 4).alias("mean_days"), "negative")
