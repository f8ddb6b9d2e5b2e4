"""The folder every executor can reach, and results written there once."""

from __future__ import annotations

import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="stallbook-")


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without the setting: there, and nowhere else,
    a temporary folder is visible to every task.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    return _local_folder(spark.conf.get("spark.app.id"))


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder for results that live as long as the driver.

    DataFrames may read it until then, so it goes when the driver ends.
    """
    parent = f"{shared_folder(spark)}/{purpose}-{uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(parent)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{parent}/data"


def pinned(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts the lineage, survives lost executors, and fixes values that a second
    evaluation could give differently (``spark_partition_id`` after a range
    partitioning). Parquet rather than ``checkpoint()``, so later readers take
    only the columns they use.
    """
    path = new_folder(df.sparkSession, "pinned")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
