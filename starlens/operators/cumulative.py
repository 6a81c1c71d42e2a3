"""Cumulative analysis: running totals and expanding averages over a period series.

These operators take an *aggregated* series (one row per period, e.g. the
output of :func:`starlens.operators.change_over_time.trend`). Its size is bounded by the
calendar (months or years in the data), not by the fact table, so a window
without PARTITION BY, which Spark evaluates in one task, stays small at any
data volume. With ``partition_by`` the window is spread by partition key.

Frames follow SQL: with ORDER BY the frame is RANGE UNBOUNDED PRECEDING to
CURRENT ROW (peers share a value); NULL order keys sort first and accumulate
first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from starlens.functions.columns import as_cols
from starlens.functions.dates import month_start, year_start
from starlens.functions.numeric import avg_of, is_integral


def running_window(order_by: str, partition_by=None) -> WindowSpec:
    parts = as_cols(partition_by)
    w = Window.partitionBy(*parts) if parts else Window
    return w.orderBy(F.col(order_by).asc_nulls_first()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )


def running_total(
    series: DataFrame,
    order_by: str,
    measure: str,
    out: str = "running_total",
    partition_by=None,
) -> DataFrame:
    """SUM(measure) OVER ([PARTITION BY p] ORDER BY order_by).

    ``partition_by`` resets the accumulation per key, e.g. ``F.year(col)``
    for a running total that restarts every January. Partitioning by the
    order column itself gives one row per partition and so returns the
    measure unchanged (the reference keeps that as a documented mistake).
    """
    return series.withColumn(out, F.sum(measure).over(running_window(order_by, partition_by)))


def expanding_avg(
    series: DataFrame,
    order_by: str,
    measure: str,
    out: str,
    mode: str = "truncate",
    partition_by=None,
) -> DataFrame:
    """AVG(measure) OVER (ORDER BY order_by): an expanding, unweighted mean.

    The reference calls it a moving average but the frame starts at the
    first row. ``mode="truncate"`` keeps the integral AVG of whole-number input.
    """
    w = running_window(order_by, partition_by)
    return series.withColumn(out, avg_of(measure, mode, over=w, integral=is_integral(series, measure)))


def period_totals(
    fact: DataFrame,
    alias: str,
    grain: str = "month",
    date_col: str = "order_date",
    measure_col: str = "sales_amount",
    measure_alias: str = "total_sales",
    drop_null_dates: bool = True,
) -> DataFrame:
    """SUM(measure) per month or year start (a DATE bucket); the input series."""
    truncate = {"month": month_start, "year_start": year_start}[grain]
    df = fact.filter(F.col(date_col).isNotNull()) if drop_null_dates else fact
    return df.groupBy(truncate(date_col).alias(alias)).agg(
        F.sum(measure_col).alias(measure_alias)
    )


def running_sales(
    fact: DataFrame,
    alias: str = "order_month",
    reset_by=None,
    partition_by_period: bool = False,
) -> DataFrame:
    """Monthly sales with their running total.

    ``reset_by`` is a function of the period column (e.g. ``F.year``) that
    restarts the total; ``partition_by_period`` reproduces the degenerate
    PARTITION BY on the period itself.
    """
    series = period_totals(fact, alias)
    if partition_by_period:
        parts = [alias]
    elif reset_by is not None:
        parts = [reset_by(F.col(alias))]
    else:
        parts = None
    return running_total(series, alias, "total_sales", partition_by=parts).select(
        alias, "total_sales", "running_total"
    )


def running_quantity_shipped(fact: DataFrame) -> DataFrame:
    """Quantity per ship month and its running total; the NULL month is kept first."""
    series = period_totals(
        fact,
        "shipping_month",
        date_col="shipping_date",
        measure_col="quantity",
        measure_alias="monthly_qty_shipped",
        drop_null_dates=False,
    )
    out = running_total(series, "shipping_month", "monthly_qty_shipped", out="running_qty")
    return out.orderBy(F.col("shipping_month").asc_nulls_first())


def yearly_running_with_avg_price(fact: DataFrame, mode: str = "truncate") -> DataFrame:
    """Per year: total sales, their running total and the expanding mean of the yearly mean price."""
    yearly = (
        fact.filter(F.col("order_date").isNotNull())
        .groupBy(year_start("order_date").alias("order_date"))
        .agg(F.sum("sales_amount").alias("total_sales"), avg_of("price", mode, integral=is_integral(fact, "price")).alias("avg_price"))
    )
    out = running_total(yearly, "order_date", "total_sales")
    out = expanding_avg(out, "order_date", "avg_price", "moving_avg_price", mode=mode)
    return out.select("order_date", "total_sales", "running_total", "moving_avg_price")
