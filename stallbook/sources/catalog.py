"""Published versions as external tables of Spark's catalog, and questions to it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register(spark: SparkSession, database: str, paths: Mapping[str, str], location: str | None = None) -> None:
    """Make ``database`` hold exactly the tables at ``paths``. Their data stays where it is."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
    for table in spark.catalog.listTables(database):
        if not table.isTemporary:
            spark.sql(f"DROP TABLE `{database}`.`{table.name}`")
    for name, path in paths.items():
        spark.sql(f"CREATE TABLE `{database}`.`{name}` USING parquet LOCATION :path", args={"path": path})


def unregister(spark: SparkSession, database: str) -> None:
    """Forget the tables; their data stays."""
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def columns(spark: SparkSession, database: str) -> DataFrame:
    """(table, column, type, nullable, description) of every column of a database, one row each."""
    found = [(table.name, column.name, column.dataType, column.nullable, column.description)
             for table in spark.catalog.listTables(database) if not table.isTemporary
             for column in spark.catalog.listColumns(f"`{database}`.`{table.name}`")]
    return spark.createDataFrame(
        found, "table string, column string, type string, nullable boolean, description string")


def columns_like(spark: SparkSession, database: str, pattern: str, escape: str = "\\") -> DataFrame:
    """The columns whose name is LIKE ``pattern``: ``%`` any signs, ``_`` one, either itself after ``escape``."""
    return columns(spark, database).where(F.like("column", F.lit(pattern), F.lit(escape)))
