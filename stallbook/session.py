"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lines stay together from the scan to the join, so a skewed join is split
    # even when that costs the next operator one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(name: str = "stallbook", cores: int | str = "*",
                  shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (builder
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.driver.memory", memory)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
