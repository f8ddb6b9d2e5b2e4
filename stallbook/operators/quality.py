"""Data-quality checks as jobs: one report row per check, then a loud failure.

A check is data: what it looks at and what it expects. ``run_checks`` turns a
list of them into one report; checks on the same table's rows share one scan.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook import schemas
from stallbook.functions.text import report_line
from stallbook.operators.matching import orphans, orphans_by_bitmap, unmatched, with_partner
from stallbook.sources.tables import columns_like

REPORT_COLUMNS = ["check", "subject", "expected", "actual", "passed"]


@dataclass(frozen=True)
class RowCount:
    """The table has exactly ``expected`` rows."""

    table: str
    expected: int


@dataclass(frozen=True)
class Rule:
    """No row breaks ``condition``; a row it is unknown for does not break it."""

    table: str
    name: str
    condition: str
    expected: int | None = 0  # None: report the number, enforce nothing


@dataclass(frozen=True)
class Count:
    """The rows meeting ``condition`` number ``expected``, or at most that many."""

    table: str
    name: str
    condition: str
    expected: int
    at_most: bool = False


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class UniqueKey:
    """No value of ``columns`` occurs twice."""

    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """Every ``key`` of the child rows is a ``parent_key`` of some parent row."""

    table: str
    key: str
    parent: str
    parent_key: str | None = None
    expected: int = 0
    compact: bool = False     # keys are whole numbers in a compact range: compare them as bitmaps


@dataclass(frozen=True)
class HasChild:
    """Every parent row has a child: a reference in the other direction."""

    table: str
    key: str
    child: str
    child_key: str | None = None


@dataclass(frozen=True)
class Matches:
    """The rows meeting ``condition`` whose ``key`` is among the rows of
    ``other`` meeting ``other_condition`` number ``expected``."""

    table: str
    name: str
    condition: str
    key: str
    other: str
    other_condition: str
    expected: int


@dataclass(frozen=True)
class NoColumnLike:
    """No column name in any table contains ``pattern``."""

    pattern: str


Check = RowCount | Rule | Count | NotNull | UniqueKey | Reference | HasChild | Matches | NoColumnLike
_ROW_CHECKS = (RowCount, Rule, Count, NotNull)


def _row(check: str, subject: str, expected: str) -> list:
    return [F.lit(check).alias("check"), F.lit(subject).alias("subject"), F.lit(expected).alias("expected")]


def _finish(counted: DataFrame, check: str, subject: str, expected: int | None = 0) -> DataFrame:
    """A report row from a one-row table with the column ``actual``."""
    passed = F.lit(True) if expected is None else F.col("actual") == expected
    wanted = "any" if expected is None else str(expected)
    return counted.select(*_row(check, subject, wanted), "actual", passed.alias("passed"))


def _counted(check: Check) -> Column:
    """What a check on a table's rows counts."""
    match check:
        case RowCount():
            return F.count(F.lit(1))
        case NotNull(_, column):
            return F.count_if(F.col(column).isNull())
        case Rule(_, _, condition):
            return F.count_if(~F.expr(condition))
        case Count(_, _, condition):
            return F.count_if(F.expr(condition))
    raise TypeError(f"no check on rows: {check!r}")


def _judged(check: Check, actual):
    """A check's kind, subject, what it wants, and whether ``actual``, a number or a column, is that."""
    match check:
        case RowCount(table, expected):
            return "row_count", table, str(expected), actual == expected
        case NotNull(table, column):
            return "not_null", f"{table}.{column}", "0", actual == 0
        case Rule(table, name, _, None):
            return "rule", f"{table}.{name}", "any", True
        case Rule(table, name, _, expected):
            return "rule", f"{table}.{name}", str(expected), actual == expected
        case Count(table, name, _, expected, True):
            return "count", f"{table}.{name}", f"<= {expected}", actual <= expected
        case Count(table, name, _, expected, _):
            return "count", f"{table}.{name}", str(expected), actual == expected
    raise TypeError(f"no check on rows: {check!r}")


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks on one table's rows, from one aggregate over it."""
    counts, rows = [], []
    for i, check in enumerate(checks):
        actual = F.col(f"c{i}")
        kind, subject, wanted, passed = _judged(check, actual)
        counts.append(_counted(check).alias(f"c{i}"))
        passed = passed if isinstance(passed, Column) else F.lit(passed)
        rows.append(F.struct(*_row(kind, subject, wanted), actual.alias("actual"), passed.alias("passed")))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def on_rows(checks: Iterable[Check]) -> tuple[list[Check], list[Check]]:
    """The checks that look at one row at a time, which a write can answer, and the others."""
    found = list(checks)
    return [c for c in found if isinstance(c, _ROW_CHECKS)], [c for c in found if not isinstance(c, _ROW_CHECKS)]


def metrics(checks: Sequence[Check]) -> dict[str, dict[str, Column]]:
    """The counts of checks on rows by table and name, for ``tables.write_version`` to observe."""
    found: dict[str, dict[str, Column]] = defaultdict(dict)
    for i, check in enumerate(checks):
        found[check.table][f"c{i}"] = _counted(check)
    return dict(found)


def observed_report(spark: SparkSession, checks: Sequence[Check], values: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The report of ``run_checks``, from what a write observed of the same checks' ``metrics``. Reads no table."""
    rows = []
    for i, check in enumerate(checks):
        actual = values[check.table][f"c{i}"]
        kind, subject, wanted, passed = _judged(check, actual)
        rows.append((kind, subject, wanted, actual, passed))
    return spark.createDataFrame(rows, "check string, subject string, expected string, actual long, passed boolean")


def _table_check(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    match check:
        case UniqueKey(table, columns):
            repeated = (tables[table].groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
                        .where(F.col("n") > 1))
            return _finish(repeated.agg(F.count(F.lit(1)).alias("actual")),
                           "unique_key", f"{table}({', '.join(columns)})")
        case Reference(table, key, parent, parent_key, expected, compact):
            find = orphans_by_bitmap if compact else orphans
            lost = find(tables[table], key, tables[parent], parent_key)
            return _finish(lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("actual")),
                           "reference", f"{table}.{key} -> {parent}", expected)
        case HasChild(table, key, child, child_key):
            alone = unmatched(tables[table], tables[child], key, child_key)
            return _finish(alone.agg(F.count(F.lit(1)).alias("actual")),
                           "has_child", f"{table}.{key} <- {child}")
        case Matches(table, name, condition, key, other, other_condition, expected):
            found = with_partner(tables[table].where(condition), tables[other].where(other_condition), key)
            return _finish(found.agg(F.count(F.lit(1)).alias("actual")),
                           "matches", f"{table}.{name}", expected)
        case NoColumnLike(pattern):
            # The schemas are at hand; the row count only gives the row to put it in.
            found = len(columns_like(tables, "%" + re.sub(r"([%_\\])", r"\\\1", pattern) + "%"))
            some = next(iter(tables.values()))
            return _finish(some.limit(0).agg((F.count(F.lit(1)) + F.lit(found)).alias("actual")),
                           "no_column_like", pattern)
    raise TypeError(f"not a check: {check!r}")


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One report row per check: check, subject, expected, actual, passed."""
    per_table: dict[str, list[Check]] = defaultdict(list)
    reports = []
    for check in checks:
        if isinstance(check, _ROW_CHECKS):
            per_table[check.table].append(check)
        else:
            reports.append(_table_check(tables, check))
    reports = [_row_checks(tables[name], group) for name, group in per_table.items()] + reports
    return reduce(DataFrame.unionByName, reports).select(*REPORT_COLUMNS)


class QualityError(RuntimeError):
    """At least one check failed; the message lists every one that did."""


def failures(report: DataFrame) -> DataFrame:
    """One readable line per failed check."""
    return report.where(~F.col("passed")).select(report_line("check", "subject", "expected", "actual").alias("line"))


def enforce(report: DataFrame) -> None:
    """Raise if a check failed. Collects at most one short line per check."""
    lines = [row["line"] for row in failures(report).orderBy("line").collect()]
    if lines:
        raise QualityError("\n  ".join([f"{len(lines)} checks failed:", *lines]))


# --- the declared rules of the retail model ----------------------------------

def row_counts(expected: dict[str, int]) -> list[Check]:
    return [RowCount(table, n) for table, n in expected.items()]


def unique_keys() -> list[Check]:
    return [UniqueKey(table, tuple(columns)) for table, columns in schemas.UNIQUE_KEYS]


def references() -> list[Check]:
    return [Reference(child, key, parent) for child, key, parent in schemas.REFERENCES]


def row_rules() -> list[Check]:
    return [Rule(*rule) for rule in schemas.ROW_RULES]


def reported_rules(box: tuple[float, float, float, float] | None = None) -> list[Check]:
    """Candidate rules that are counted and never enforced."""
    rules = list(schemas.REPORT_ONLY_RULES)
    if box:
        rules.append(schemas.coordinate_box(*box))
    return [Rule(*rule, expected=None) for rule in rules]


def not_nulls() -> list[Check]:
    return [NotNull(table, column) for table in schemas.TYPED_COLUMNS for column in schemas.required_columns(table)]

