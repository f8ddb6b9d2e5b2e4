"""Calendar expressions over zone-less timestamps."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(ts: Column | str) -> Column:
    """First day of the month, as a date.

    ``trunc`` gives a date; ``date_trunc`` would give a zoned timestamp.
    """
    return F.trunc(ts, "month")


def calendar_day(ts: Column | str) -> Column:
    return F.to_date(ts)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole calendar days from ``earlier`` to ``later``; negative when before."""
    return F.datediff(calendar_day(later), calendar_day(earlier))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Exact seconds from ``earlier`` to ``later``, free of time zones."""
    later, earlier = (F.col(c) if isinstance(c, str) else c for c in (later, earlier))
    gap = later - earlier
    parts = [(F.extract(F.lit(unit), gap).cast("decimal(20,6)") * F.lit(size))
             for unit, size in (("DAY", 86400), ("HOUR", 3600), ("MINUTE", 60), ("SECOND", 1))]
    return sum(parts[1:], parts[0]).cast("decimal(20,6)")


def shift(ts: Column | str, by: timedelta) -> Column:
    """``ts`` plus a fixed length of time, to the microsecond."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts + F.lit(by)


def later_day(ts: Column | str, promised: Column | str) -> Column:
    """True when ``ts`` falls on a later calendar day than ``promised``.

    The timestamp is cut to its day first. Comparing it to a date directly
    would promote the date to midnight and call the promised day itself late.
    """
    return calendar_day(ts) > calendar_day(promised)
