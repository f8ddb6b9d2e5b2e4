"""Parquet tables: reading, publishing whole versions, exporting JSON rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from datetime import datetime, timedelta, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.sources import commits

_VERSION = "v"
ARRAY_ROWS = 10_000     # rows that one JSON array may hold


class Tables(Mapping[str, DataFrame]):
    """Named DataFrames, each made when it is first asked for.

    Opening a Parquet table costs a job to learn its schema, so a query that
    needs two of nine tables opens two. ``metrics`` are what the tables' write
    observed, by table and name, where that is known.
    """

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]],
                 metrics: Mapping[str, Mapping[str, int]] | None = None) -> None:
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}
        self.metrics = dict(metrics or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def read_tables(spark: SparkSession, folder: str, names: list[str], suffix: str = ".parquet",
                metrics: Mapping[str, Mapping[str, int]] | None = None) -> Tables:
    def maker(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.parquet(f"{folder}/{name}{suffix}")

    return Tables({name: maker(name) for name in names}, metrics)


def inline_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A literal table. Its size is known to Spark, so a join may broadcast it.

    The values are bound by name: Spark binds unnamed ones inside VALUES in
    another order than they are written.
    """
    cells = {f"r{i}c{j}": value for i, row in enumerate(rows) for j, value in enumerate(row)}
    lines = ", ".join("(" + ", ".join(f":r{i}c{j}" for j in range(len(columns))) + ")" for i in range(len(rows)))
    return spark.sql(f"SELECT * FROM VALUES {lines} AS t({', '.join(columns)})", args=cells)


def write_version(tables: Mapping[str, DataFrame], root: str,
                  metrics: Mapping[str, Mapping[str, Column]] | None = None) -> tuple[str, dict[str, dict]]:
    """Write all tables into a fresh version folder; nothing points to it yet.

    ``metrics`` are aggregates per table, by name, that are worked out as the rows pass on their way to the files;
    the number of ``rows`` always is. Returns the version and the metrics' values.
    """
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    version = f"{_VERSION}{stamp}-{uuid4().hex[:8]}"
    values = {}
    for name, df in tables.items():
        wanted = {"rows": F.count(F.lit(1)), **(metrics or {}).get(name, {})}
        seen = Observation()
        passing = df.observe(seen, *[column.alias(alias) for alias, column in wanted.items()])
        passing.write.mode("overwrite").parquet(f"{root}/{version}/{name}")
        values[name] = dict(seen.get)
    return version, values


def publish(spark: SparkSession, root: str, version: str, after: int | None = None,
            metrics: Mapping[str, dict] | None = None) -> None:
    """Make ``version`` the one readers see, with its metrics.

    ``after`` is the number of the commit the writer started from. If someone else has published since, this is a
    ``commits.Conflict`` and changes nothing.
    """
    began = commits.last(spark, root) if after is None else after
    commits.commit(spark, root, began + 1, {"version": version, "metrics": metrics or {}})


def current_version(spark: SparkSession, root: str) -> str:
    return commits.read(spark, root)["version"]


def read_published(spark: SparkSession, root: str, names: list[str]) -> Tables:
    """The tables of the current version, with what their write observed."""
    found = commits.read(spark, root)
    return read_tables(spark, f"{root}/{found['version']}", names, suffix="", metrics=found["metrics"])


def read_versions(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A table in every version that is still there, with the number of its commit as ``version``.

    Read by ``schema``, today's unless given otherwise: a column that an old version lacks is NULL there, and keeps
    the schema's comment.
    """
    found = [(number, commits.read(spark, root, number)["version"]) for number in commits.numbers(spark, root)]
    paths = {number: f"{root}/{version}/{name}" for number, version in found
             if commits.listed(spark, f"{root}/{version}/{name}")}
    wanted = schema or spark.read.parquet(paths[max(paths)]).schema
    whole = [spark.read.schema(wanted).parquet(path).withColumn("version", F.lit(number).cast("long"))
             for number, path in paths.items()]
    return reduce(DataFrame.unionByName, whole)


def reload(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], gate: Callable[[Tables], None],
           metrics: Mapping[str, Mapping[str, Column]] | None = None) -> Tables:
    """Replace all tables at once, if the written version passes ``gate``.

    The gate gets the written tables with the metrics their write observed. Running it twice gives the same published
    rows. A failing gate, or another writer who published since this one began, raises, leaves what was published
    and removes what this run wrote.
    """
    began = commits.last(spark, root)
    version, values = write_version(tables, root, metrics)
    written = read_tables(spark, f"{root}/{version}", list(tables), suffix="", metrics=values)
    try:
        gate(written)
        publish(spark, root, version, began, values)
    except BaseException:
        commits.remove(spark, f"{root}/{version}")
        raise
    return written


def vacuum(spark: SparkSession, root: str, keep: int = 2, older_than: timedelta = timedelta(days=7)) -> list[str]:
    """Delete the versions that the last ``keep`` commits do not name, unless they are younger than ``older_than``.

    Those are old versions, and what runs that died have left. Returns their names.
    """
    named = [commits.read(spark, root, number)["version"] for number in commits.numbers(spark, root)[-keep:]]
    return commits.remove_unnamed(spark, root, _VERSION, named, older_than)


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON object; stays distributed, and ``.write.text`` writes it from the tasks."""
    return df.select(F.to_json(F.struct("*")).alias("json"))


def json_array(df: DataFrame, most: int = ARRAY_ROWS) -> DataFrame:
    """All rows in one JSON array, ``[]`` when there are none.

    Collects the rows into one value, so more than ``most`` rows are an error;
    use ``json_rows`` for a table.
    """
    rows = df.limit(most + 1).agg(F.collect_list(F.struct("*")).alias("rows"))
    error = F.raise_error(F.lit(f"json_array is for {most} rows at most; use json_rows"))
    return rows.select(F.when(F.size("rows") <= most, F.to_json("rows")).otherwise(error).alias("json"))


def columns_like(tables: Mapping[str, DataFrame], pattern: str, escape: str = "\\") -> list[tuple[str, str]]:
    """Columns whose name is LIKE ``pattern``, from the schemas alone."""
    signs = {"%": ".*", "_": "."}
    parts, escaped = [], False
    for sign in pattern:
        if escaped or sign != escape:
            parts.append(re.escape(sign) if escaped else signs.get(sign, re.escape(sign)))
            escaped = False
        else:
            escaped = True
    if escaped:
        raise ValueError(f"{pattern!r} ends in its escape sign")
    like = re.compile("".join(parts), re.DOTALL)
    return [(name, column) for name, df in tables.items() for column in df.columns if like.fullmatch(column)]
