"""Date buckets and calendar-boundary differences.

All buckets are built-in Catalyst expressions, so they stay inside
whole-stage codegen and can be used as grouping keys or window partitions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlens.functions.columns import as_col


# Fixed value of the reference: the year-month label format (e.g. 2011-Jan).
MONTH_LABEL_FORMAT = "yyyy-MMM"


def year_number(d: Column | str) -> Column:
    """YEAR(d): an int like 2013."""
    return F.year(as_col(d))


def month_number(d: Column | str) -> Column:
    """MONTH(d): 1..12; merges the same month of different years."""
    return F.month(as_col(d))


def month_start(d: Column | str) -> Column:
    """DATETRUNC(MONTH, d): first day of the month, still a DATE.

    ``trunc`` keeps DateType; ``date_trunc`` would return a timestamp.
    """
    return F.trunc(as_col(d), "month")


def year_start(d: Column | str) -> Column:
    """DATETRUNC(YEAR, d): January 1st of the year, a DATE."""
    return F.trunc(as_col(d), "year")


def month_label(d: Column | str) -> Column:
    """FORMAT(d, 'yyyy-MMM'), e.g. ``2011-Jan``; a string, so it sorts alphabetically."""
    return F.date_format(as_col(d), MONTH_LABEL_FORMAT)


GRAINS = {
    "year": year_number,
    "month_number": month_number,
    "month": month_start,
    "year_start": year_start,
    "month_label": month_label,
}


def bucket(d: Column | str, grain: str) -> Column:
    """Map a date to its period for ``grain`` (one of :data:`GRAINS`)."""
    try:
        return GRAINS[grain](d)
    except KeyError:
        raise ValueError(f"unknown grain {grain!r}; expected one of {sorted(GRAINS)}") from None


def month_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end``.

    This is the calendar count of DATEDIFF(MONTH, start, end):
    2011-01-31 -> 2011-02-01 is 1, not 0 as ``months_between`` would give.
    """
    s, e = as_col(start), as_col(end)
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


def year_boundaries(start: Column | str, end: Column | str) -> Column:
    """DATEDIFF(YEAR, start, end): year boundaries crossed (age as the reference counts it)."""
    return F.year(as_col(end)) - F.year(as_col(start))


def as_of_date(as_of) -> Column:
    """Reporting date: a fixed date (reproducible) or, if None, today.

    The reference uses the current date, which makes ages and recency drift
    between runs; passing ``as_of`` pins them.
    """
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")
