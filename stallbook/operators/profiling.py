"""Reports on landed data, taken before anything is decided about it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import dates, numbers
from stallbook.functions.casts import is_valid
from stallbook.functions.text import has_byte_order_mark, utf8_hex
from stallbook.operators.matching import distinct_keys, orphans, unmatched
from stallbook.operators.ordered import split_running_sum


def _stacked(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def key_uniqueness(tables: Mapping[str, DataFrame], candidates: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Rows and distinct values per candidate key.

    A single column is counted as SQL counts it, without NULLs. A composite
    key is a row value, and a row of NULLs is still a value. Each candidate
    reads only its own columns, so the branches share no bytes.
    """
    def one(table: str, columns: Sequence[str]) -> DataFrame:
        per_key = tables[table].groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
        counted = F.count(F.lit(1)) if len(columns) > 1 else F.count(columns[0])
        label = f"{table}.{columns[0]}" if len(columns) == 1 else f"{table} ({', '.join(columns)})"
        return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), counted.alias("distinct_vals")).select(
            F.lit(label).alias("candidate_key"), "rows", "distinct_vals")

    return _stacked([one(t, c) for t, c in candidates]).orderBy("candidate_key")


def cast_validity(tables: Mapping[str, DataFrame], casts: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Non-NULL and uncastable values per (table, column, type); one scan per table."""
    def one(table: str) -> DataFrame:
        wanted = [(c, t) for name, c, t in casts if name == table]
        counts, rows = [], []
        for i, (column, type_name) in enumerate(wanted):
            counts += [F.count(column).alias(f"n{i}"), F.count_if(~is_valid(column, type_name)).alias(f"b{i}")]
            rows.append(F.struct(F.lit(f"{table}.{column} -> {type_name}").alias("col"),
                                 F.col(f"n{i}").alias("non_null"), F.col(f"b{i}").alias("bad")))
        return tables[table].agg(*counts).select(F.inline(F.array(*rows)))

    return _stacked([one(t) for t in dict.fromkeys(name for name, _, _ in casts)]).orderBy("col")


def missing_by(df: DataFrame, group: str, columns: dict[str, str]) -> DataFrame:
    """Rows per group, and how many of them lack each of ``columns`` (name -> label)."""
    return (df.groupBy(group)
            .agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count_if(F.col(c).isNull()).alias(label) for c, label in columns.items()])
            .orderBy(F.desc("rows"), group))


def group_sizes(df: DataFrame, key: str, size: str = "rows_per_key", groups: str = "how_many_keys") -> DataFrame:
    """How many keys have one row, two rows, and so on."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(size))
            .groupBy(size).agg(F.count(F.lit(1)).alias(groups)).orderBy(size))


def orphan_report(tables: Mapping[str, DataFrame],
                  relations: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Child rows without a parent per (child, key, parent, parent key)."""
    def one(child: str, key: str, parent: str, parent_key: str) -> DataFrame:
        lost = orphans(tables[child], key, tables[parent], parent_key)
        return lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows")).select(
            F.lit(f"{child}.{key} -> {parent}").alias("relation"), "orphan_rows")

    return _stacked([one(*r) for r in relations]).orderBy(F.desc("orphan_rows"), "relation")


def missing_lookups(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str | None = None) -> DataFrame:
    """Which keys the lookup lacks, and how many rows use each."""
    return orphans(df, key, lookup, lookup_key).orderBy(F.desc("rows"), key)


def coverage_gaps(tables: Mapping[str, DataFrame], relations: Sequence[tuple[str, str, str, str]],
                  nullable: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Parents without a child per (parent, key, child, child key), and rows
    without a value per (table, column)."""
    def childless(parent: str, key: str, child: str, child_key: str) -> DataFrame:
        alone = unmatched(tables[parent].select(key), tables[child], key, child_key)
        return alone.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(f"{parent} with no {child}").alias("gap"), "rows")

    def valueless(table: str, column: str) -> DataFrame:
        return tables[table].agg(F.count_if(F.col(column).isNull()).alias("rows")).select(
            F.lit(f"{table} with NULL {column}").alias("gap"), "rows")

    reports = [childless(*r) for r in relations] + [valueless(*n) for n in nullable]
    return _stacked(reports).orderBy(F.desc("rows"), "gap")


def encoding_sample(df: DataFrame, column: str) -> DataFrame:
    """One value with the hex of its bytes: the smallest, so always the same."""
    return (df.select(column).where(F.col(column).isNotNull())
            .orderBy(column).limit(1).withColumn("hex", utf8_hex(column)))


def byte_order_marks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values per column that begin with a byte order mark."""
    marks = df.agg(*[F.count_if(has_byte_order_mark(c)).alias(c) for c in columns])
    return marks.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("marked"))
                                           for c in columns])))


def uncovered_keys(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str) -> DataFrame:
    """Distinct keys in use that the lookup does not cover."""
    return distinct_keys(df, key).join(distinct_keys(lookup, lookup_key, key), key, "left_anti")


def gap_statistics(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Median and mean days from ``earlier`` to ``later``, and how many are negative.

    The median is exact and never gathers the gaps: equal gaps become one row
    with their count, and the running count shows which row is in the middle.
    """
    gaps = (df.where(F.col(earlier).isNotNull() & F.col(later).isNotNull())
            .groupBy(dates.seconds_between(later, earlier).alias("seconds"))
            .agg(F.count(F.lit(1)).alias("n")))
    placed = split_running_sum(gaps, [], [F.col("seconds").asc()], "n", "upto")
    rows = F.coalesce(placed.agg(F.max("upto")).scalar(), F.lit(0))

    def at(position: Column) -> Column:
        holds = (F.col("upto") >= position) & (F.col("upto") - F.col("n") < position)
        return F.max(F.when(holds, F.col("seconds"))).cast("double")

    day = F.lit(86400.0)
    # For an even number of rows the median lies between the two middle ones.
    median = (at(F.floor((rows + 1) / 2)) + at(F.floor((rows + 2) / 2))) / 2
    total = F.sum(F.col("seconds") * F.col("n")).cast("double")
    return placed.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.round(median / day, 4).alias("median_days"),
        F.round(F.try_divide(total, F.sum("n")) / day, 4).alias("mean_days"),
        F.coalesce(F.sum(F.when(F.col("seconds") < 0, F.col("n"))), F.lit(0)).alias("negative"))


def conflicting_duplicates(df: DataFrame, key: str, score: str) -> DataFrame:
    """Keys with several rows: do their scores agree, and how far apart are they?"""
    repeated = (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), (F.max(score) - F.min(score)).alias("gap"))
                .where(F.col("n") > 1))
    kind = F.when(F.col("gap") > 0, "conflicting").otherwise("identical")
    return (repeated.groupBy(kind.alias("scores"))
            .agg(F.count(F.lit(1)).alias("keys"), numbers.mean("gap", 2).alias("mean_gap"),
                 F.max("gap").alias("worst_gap"))
            .orderBy("scores"))


def attribute_multiplicity(df: DataFrame, person: str, attributes: Sequence[str]) -> DataFrame:
    """Persons with more than one value of each attribute, and the most rows of one person."""
    # min < max tells "more than one value" without keeping the values.
    several = [(F.min(a) < F.max(a)).alias(f"several_{a}") for a in attributes]
    per_person = df.groupBy(person).agg(F.count(F.lit(1)).alias("rows"), *several)
    return per_person.agg(
        F.count(F.lit(1)).alias("persons"),
        *[F.count_if(F.col(f"several_{a}")).alias(f"several_{a}") for a in attributes],
        F.max("rows").alias("most_rows"))

