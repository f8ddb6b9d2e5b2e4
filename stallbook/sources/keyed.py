"""A Parquet table dealt into buckets by a hash of its key, where a change rewrites only the buckets it touches.

Every bucket lies in the folder of the write that made it last, and the last commit names that write for each bucket.
A change writes new files for its buckets and then commits the new list: readers see all of it or nothing, files of
other buckets are not touched, and a run that dies leaves nothing but unnamed files. (Overwriting the buckets' folders
in place would leave a bucket missing between its removal and its replacement.)
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import timedelta
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.sources import commits
from stallbook.sources.shared import pinned

_BUCKET, _WRITE = "_bucket", "_write"


@dataclass(frozen=True)
class KeyedTable:
    """The table under ``path``. Choose ``buckets`` so that one fits a task: keys are unique, so buckets are even."""

    spark: SparkSession
    path: str

    @classmethod
    def create(cls, df: DataFrame, path: str, key: str, buckets: int) -> KeyedTable:
        """Write ``df`` as a new table. Its keys must be unique; one may be NULL."""
        clash = {_BUCKET, _WRITE} & set(df.columns)
        if clash or key not in df.columns:
            raise ValueError(f"columns {sorted(clash)} are the table's own" if clash else f"no column {key}")
        table = cls(df.sparkSession, path)
        state = {"key": key, "buckets": buckets, "schema": df.schema.json(), "writes": {}}
        if commits.last(table.spark, path):
            raise commits.Conflict(f"{path} holds a table")
        rows = pinned(df.withColumn(_BUCKET, _bucket(F.col(key), buckets)))
        _refuse_repeats(rows, key)
        table._replace(state, 0, rows, _buckets_of(rows))
        return table

    def exists(self) -> bool:
        return commits.last(self.spark, self.path) > 0

    def read(self) -> DataFrame:
        """The whole table as of the last commit."""
        return self._read(commits.read(self.spark, self.path)).drop(_BUCKET)

    def merge(self, new: DataFrame, insert: bool = True) -> list[int]:
        """Give the rows with a key of ``new`` its other columns' values; returns the buckets that were rewritten.

        Columns that ``new`` lacks keep their values. Keys that the table lacks become rows, unless ``insert`` is
        false. A key that comes twice in ``new`` is an error. ``Conflict`` if someone else committed meanwhile.
        """
        began = commits.last(self.spark, self.path)
        state = commits.read(self.spark, self.path, began)
        key, schema = state["key"], T.StructType.fromJson(json.loads(state["schema"]))
        unknown = set(new.columns) - set(schema.names)
        if unknown or key not in new.columns:
            raise ValueError(f"columns {sorted(unknown)} are not in the table" if unknown else f"no column {key}")
        given = [f for f in schema.fields if f.name in new.columns]
        fresh = pinned(new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in given])
                       .withColumn(_BUCKET, _bucket(F.col(key), state["buckets"])))
        _refuse_repeats(fresh, key)
        touched = _buckets_of(fresh)
        if not insert:
            touched = [b for b in touched if str(b) in state["writes"]]
        if not touched:
            return []
        side = fresh.where(F.col(_BUCKET).isin(touched)).drop(_BUCKET).select(
            F.lit(True).alias("_hit"), *[F.col(f.name).alias(f"_new_{k}") for k, f in enumerate(given)])
        at = {f.name: f"_new_{k}" for k, f in enumerate(given)}
        old = self._read(state, touched).drop(_BUCKET).withColumn("_old", F.lit(True))
        joined = old.join(side, F.col(key).eqNullSafe(F.col(at[key])), "full_outer" if insert else "left")
        merged = joined.select(*[
            (F.when(F.col("_hit"), F.col(at[f.name])).otherwise(F.col(f.name)) if f.name in at else F.col(f.name))
            .alias(f.name) for f in schema.fields])
        self._replace(state, began, merged.withColumn(_BUCKET, _bucket(F.col(key), state["buckets"])), touched)
        return touched

    def vacuum(self, older_than: timedelta = timedelta(days=7)) -> list[str]:
        """Delete the files that the last commit does not name, unless they are younger than ``older_than``."""
        named = {f"{_WRITE}={w}" for w in commits.read(self.spark, self.path)["writes"].values()}
        return commits.remove_unnamed(self.spark, self.path, f"{_WRITE}=", named, older_than)

    def files(self) -> dict[str, int]:
        """The table's data files and their sizes, from the file system."""
        found = {}
        for bucket, write in commits.read(self.spark, self.path)["writes"].items():
            for status in commits.listed(self.spark, f"{self.path}/{_WRITE}={write}/{_BUCKET}={bucket}"):
                if status.getPath().getName().endswith(".parquet"):
                    found[f"{bucket}/{status.getPath().getName()}"] = status.getLen()
        return found

    def _read(self, state: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        wanted = state["writes"] if buckets is None else [str(b) for b in buckets if str(b) in state["writes"]]
        paths = [f"{self.path}/{_WRITE}={state['writes'][b]}/{_BUCKET}={b}" for b in wanted]
        whole = T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], whole)
        stored = T.StructType([*whole.fields, T.StructField(_WRITE, T.StringType())])
        return self.spark.read.schema(stored).option("basePath", self.path).parquet(*paths).drop(_WRITE)

    def _replace(self, state: dict, began: int, rows: DataFrame, buckets: list[int]) -> None:
        """Write ``rows``, which make up ``buckets`` whole, and commit."""
        write = uuid4().hex
        folder = f"{self.path}/{_WRITE}={write}"
        rows.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(folder)
        writes = {**state["writes"], **{str(b): write for b in buckets}}
        try:
            commits.commit(self.spark, self.path, began + 1, {**state, "writes": writes})
        except commits.Conflict:
            commits.remove(self.spark, folder)
            raise


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _buckets_of(rows: DataFrame) -> list[int]:
    """The buckets that occur: as many as the table has at most."""
    return sorted(row[_BUCKET] for row in rows.select(_BUCKET).distinct().collect())


def _refuse_repeats(rows: DataFrame, key: str) -> None:
    twice = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).limit(1).collect()
    if twice:
        raise ValueError(f"{key} {twice[0][key]!r} comes more than once")
