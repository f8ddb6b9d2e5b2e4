import pytest
from pyspark.sql import functions as F

from stallbook.operators import profiling, sketches
from stallbook.sources import tables

KEYS = [("t", ["k"]), ("t", ["k", "m"]), ("t", ["z"])]


@pytest.fixture(scope="module")
def batches(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 20_000).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("m"),
        F.lit(None).cast("int").alias("z"), F.timestamp_seconds(F.lit(0)).cast("timestamp_ntz").alias("a"),
        F.timestamp_seconds((F.col("id") * 7919) % 100_000 - 20_000).cast("timestamp_ntz").alias("b"))
    return [rows.where(f"k % 3 = {i}") for i in range(3)] + [rows.where("false")], rows


def written(spark, path, parts, metrics):
    return [tables.write_version({"t": part}, str(path), {"t": metrics})[1] for part in parts]


def test_distinct_counts_add_up(spark, tmp_path, batches):
    """Also where batches share values: the union is counted, not the sum."""
    parts, whole = batches
    found = sketches.distinct_counts(spark, written(spark, tmp_path, [*parts, parts[0]], sketches.distinct_metrics(KEYS)["t"]), KEYS)
    exact = {r[0]: r for r in profiling.key_uniqueness({"t": whole}, KEYS).collect()}
    for row in found.collect():
        assert row["rows"] == 60_000 + parts[0].count()
        distinct = exact[row["candidate_key"]]["distinct_vals"]
        assert abs(row["distinct_estimate"] - distinct) <= sketches.distinct_error() * distinct
    assert exact["t.z"]["distinct_vals"] == 0
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()


def test_smaller_sketches_are_less_sure(spark, tmp_path, batches):
    parts, _ = batches
    metrics = sketches.distinct_metrics(KEYS[:1], log_buckets=8)["t"]
    (row,) = sketches.distinct_counts(spark, written(spark, tmp_path, parts, metrics), KEYS[:1]).collect()
    assert abs(row["distinct_estimate"] - 20_000) <= sketches.distinct_error(8) * 20_000


def test_median_adds_up(spark, tmp_path, batches):
    parts, whole = batches
    values = [v["t"] for v in written(spark, tmp_path, parts, sketches.gap_metrics("a", "b"))]
    found, exact = sketches.gap_statistics(spark, values).first(), profiling.gap_statistics(whole, "a", "b").first()
    assert (found["rows"], found["mean_days"], found["negative"]) == (exact["rows"], exact["mean_days"], exact["negative"])
    gaps = sorted((i * 7919) % 100_000 - 20_000 for i in range(60_000))
    below = sum(g < found["median_days"] * 86400 for g in gaps) / len(gaps)
    assert abs(below - 0.5) <= sketches.rank_error()


def test_nothing_yet(spark, tmp_path, batches):
    empty = batches[0][3]
    metrics = {**sketches.distinct_metrics(KEYS)["t"], **sketches.gap_metrics("a", "b")}
    values = written(spark, tmp_path, [empty], metrics)
    assert {tuple(r)[1:] for r in sketches.distinct_counts(spark, values, KEYS).collect()} == {(0, 0)}
    assert tuple(sketches.gap_statistics(spark, [values[0]["t"]]).first()) == (0, None, None, 0)
