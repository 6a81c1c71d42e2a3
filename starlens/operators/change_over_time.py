"""Change over time: measures of the fact per calendar bucket.

Plan shape: scan (pruned to the date and measure columns, ``IsNotNull``
pushed into the scan) -> partial HashAggregate per task -> shuffle of at
most (#buckets x #tasks) partial rows -> final aggregate. A hot bucket
(one month holding a third of all sales) costs nothing extra because the
map side has already combined it. ``COUNT(DISTINCT customer_key)`` shuffles
on (bucket, customer_key) first, so it is spread by customer, not by bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.functions.dates import bucket, month_label

# Named measures over fact_sales (aliases are the reference's column names).
MEASURES: dict[str, Callable[[], Column]] = {
    "total_sales": lambda: F.sum("sales_amount"),
    "total_customers": lambda: F.count_distinct("customer_key"),
    "total_qty": lambda: F.sum("quantity"),
}

OVERVIEW = ("total_sales", "total_customers", "total_qty")

Measure = str | tuple[str, Column]
Key = tuple[str, str]  # (output alias, grain)


def _measure(m: Measure) -> Column:
    if isinstance(m, str):
        return MEASURES[m]().alias(m)
    name, expr = m
    return expr.alias(name)


def trend(
    fact: DataFrame,
    by: Sequence[Key],
    measures: Sequence[Measure] = OVERVIEW,
    date_col: str = "order_date",
    drop_null_dates: bool = True,
    sort: bool = True,
    chronological: bool = False,
) -> DataFrame:
    """Aggregate ``measures`` per date bucket.

    ``by`` lists ``(alias, grain)`` pairs, e.g. ``[("order_year", "year"),
    ("order_month", "month_number")]``. Rows whose date is NULL are dropped
    unless ``drop_null_dates`` is False, in which case they form a NULL bucket.
    Output is sorted by the bucket columns (NULL first), as the reference does;
    a ``month_label`` bucket then sorts as text (``2011-Apr`` before
    ``2011-Jan``). ``chronological=True`` sorts by each bucket's earliest date
    instead (the label itself is unchanged).
    """
    df = fact.filter(F.col(date_col).isNotNull()) if drop_null_dates else fact
    date = F.col(date_col)
    keys, finals = [], []
    for alias, grain in by:
        if grain == "month_label":
            # The label is a one-to-one function of the month start: group on
            # the date and format only the aggregated rows, not every sale.
            hidden = f"__{alias}_month"
            keys.append(bucket(date, "month").alias(hidden))
            finals.append(month_label(F.col(hidden)).alias(alias))
        else:
            keys.append(bucket(date, grain).alias(alias))
            finals.append(F.col(alias))
    aggs = [_measure(m) for m in measures]
    names = [m if isinstance(m, str) else m[0] for m in measures]
    first = "__first_date"
    chrono = sort and chronological
    if chrono:
        aggs.append(F.min(date_col).alias(first))
    out = df.groupBy(*keys).agg(*aggs).select(*finals, *names, *([first] if chrono else []))
    if not sort:
        return out
    order = [F.col(first).asc_nulls_first()] if chrono else []
    out = out.orderBy(*order, *[alias for alias, _ in by])
    return out.drop(first) if chrono else out


def new_entities(
    dim: DataFrame,
    alias: str = "year_created",
    grain: str = "year",
    date_col: str = "create_date",
    key: str = "customer_key",
    count_alias: str = "total_customers",
    sort: bool = True,
) -> DataFrame:
    """How many entities were created per period: COUNT(key) by bucket(date).

    No date filter: rows without a creation date form a NULL bucket, and
    rows with a NULL key are not counted.
    """
    out = dim.groupBy(bucket(F.col(date_col), grain).alias(alias)).agg(
        F.count(key).alias(count_alias)
    )
    return out.orderBy(alias) if sort else out
