"""Turning landed text into typed tables.

Each rule is an operator of its own; ``plans.retail`` puts them together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook import schemas
from stallbook.functions import dates
from stallbook.operators.matching import distinct_keys


def typed_projection(df: DataFrame, table: str, source_names: dict[str, str] | None = None) -> DataFrame:
    """Cast landed text to the declared columns of ``table``.

    ``source_names`` maps a typed column to a landed column spelt differently.
    A declared column that was never landed becomes NULL. A value that does not
    parse fails the job.
    """
    source_names = source_names or {}
    ansi = df.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"
    columns = []
    for column in schemas.typed_columns(table):
        source = source_names.get(column.name, column.name)
        value = F.col(source) if source in df.columns else F.lit(None)
        cast = value.cast(column.type) if ansi else _strict_cast(value, column.type, source)
        columns.append(cast.alias(column.name, metadata=column.metadata))
    return df.select(*columns)


def _strict_cast(value: Column, type_name: str, name: str) -> Column:
    """A cast that fails as under ANSI where the session would give NULL."""
    cast = value.cast(type_name)
    bad = F.raise_error(F.concat(F.lit(f"{name} is no {type_name}: "), value.cast("string")))
    return F.when(value.isNull() | cast.isNotNull(), cast).otherwise(bad)


def unusable(parents: DataFrame, condition: Column, key: str) -> DataFrame:
    """Keys of the parents that satisfy ``condition``."""
    return distinct_keys(parents.where(condition), key)


def drop_rows(df: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """``df`` without the rows whose ``key`` is in ``dropped``."""
    return df.join(dropped, key, "left_anti")


def drop_owners(owners: DataFrame, parents: DataFrame, dropped: DataFrame, key: str, owner_key: str) -> DataFrame:
    """``owners`` without those of the dropped parents.

    An owner row that exists for one parent alone would otherwise outlive it.
    """
    owned = distinct_keys(parents.join(dropped, key, "left_semi"), owner_key)
    return drop_rows(owners, owned, owner_key)


def drop_with_dependents(parents: DataFrame, dropped: DataFrame, key: str,
                         children: Mapping[str, DataFrame],
                         owners: DataFrame, owner_key: str) -> dict[str, DataFrame]:
    """Remove ``dropped`` parents together with everything that hangs on them:
    the children, which would refer to nothing, and the owners."""
    kept = {name: drop_rows(df, dropped, key) for name, df in children.items()}
    return {"parents": drop_rows(parents, dropped, key),
            "owners": drop_owners(owners, parents, dropped, key, owner_key), **kept}


def impute_from(df: DataFrame, target: str, source: str, offset: timedelta, when: Column) -> DataFrame:
    """Fill a missing ``target`` with ``source + offset`` on the rows of ``when``.

    Elsewhere, or without a ``source``, a missing value stays missing.
    """
    fill = when & F.col(target).isNull() & F.col(source).isNotNull()
    return df.withColumn(target, F.when(fill, dates.shift(source, offset)).otherwise(F.col(target)))


def dedupe_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without their exact copies; copies vanish before the shuffle."""
    return (df.select(*columns) if columns else df).distinct()
