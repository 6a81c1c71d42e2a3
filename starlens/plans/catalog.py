"""

Each entry is ``(spark, data_dir) -> DataFrame``. The star is derived from
the test tables in ``data_dir`` once and written to the shared checkpoint
folder (see :func:`starlens.sources.star.materialized_star`); every query
then reads the whole gold tables, so its work grows with them. Nothing is
capped or sampled except the previews, whose row limit is the feature being
reproduced. Queries that drop undated sales read ``s.dated_sales()`` (which
skips the NULL-year folder of the gold fact); the others read the whole fact.

Parameters for the test data (FIXTURES.md section 2): with the reference's
own thresholds every customer and product of these tables would land in one
class, so the bounds below are scaled to the data. The operators' defaults
are the reference values; the ``..._reference_bounds`` keys run with them.

The ``running_line_...`` keys scan order lines (:mod:`starlens.operators.prefix_scan`). The
``lattice_...`` keys answer from stored summaries
(:mod:`starlens.operators.lattice`), built once per input version; the ``bitmap_...``
keys count distinct keys by bitmaps (:mod:`starlens.operators.distinct_bitmaps`); the
``known_...`` keys tell known keys by a membership filter (:mod:`starlens.operators.known_keys`),
the ``copartitioned_...`` keys read sales that lie with their dimension
(:mod:`starlens.sources.copartitioned`); the ``live_...`` keys read catalog views that are re-evaluated on every read
(:mod:`starlens.sources.live_views`), under names of the input version.

The ``incremental_...`` keys answer from a state that reads only new files
(:mod:`starlens.operators.increments`).

The ``view_...`` keys publish a report under a catalog name (see
:func:`starlens.sources.sinks.publish_report`) and answer from that name, as
the reference's readers do.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.operators import increments as inc
from starlens.operators import part_to_whole as ctb
from starlens.operators import cumulative as cum
from starlens.operators import inspect_rows as rows
from starlens.operators import performance as perf
from starlens.operators import reports as rep
from starlens.operators import segmentation as seg
from starlens.operators.change_over_time import OVERVIEW, new_entities, trend
from starlens.operators.lattice import Lattice, fresh_lattice
from starlens.operators.prefix_scan import running_rows
from starlens.session import writable_root
from starlens.sources.copartitioned import GRAIN, CoPartitioned, open_copartitioned, write_copartitioned
from starlens.sources.live_views import catalog_star, create_live_reports, read_view
from starlens.sources.publish import build_folder, published
from starlens.sources.sinks import publish_report
from starlens.sources.star import Star, materialized_star, write_star

# Parameters for the derived test star (FIXTURES.md section 2).
AS_OF = datetime.date(2001, 12, 31)
VIP_SPENDING = 2_000_000
MIN_MONTHS = 12
HIGH_PERFORMER = 1_800_000
MID_RANGE = 1_300_000
COST_EDGES = (925, 950, 975)

Query = Callable[[SparkSession, str], DataFrame]


def star(spark: SparkSession, data_dir: str) -> Star:
    """The star for ``data_dir``: derived once, then read from the shared folder."""
    return materialized_star(spark, data_dir)


def _star(fn):
    return lambda spark, d: fn(star(spark, d))


# --- change over time -------------------------------------------------------

def seasonal_month_sales(s: Star) -> DataFrame:
    return trend(s.dated_sales(), [("order_month", "month_number")], ["total_sales"])


def yearly_overview(s: Star) -> DataFrame:
    return trend(s.dated_sales(), [("order_year", "year")], OVERVIEW)


def seasonal_month_overview(s: Star) -> DataFrame:
    return trend(s.dated_sales(), [("order_month", "month_number")], OVERVIEW)


def year_month_overview(s: Star) -> DataFrame:
    return trend(s.dated_sales(), [("order_year", "year"), ("order_month", "month_number")], OVERVIEW)


def month_bucket_overview(s: Star) -> DataFrame:
    return trend(s.dated_sales(), [("order_date", "month")], OVERVIEW)


def year_bucket_overview(s: Star) -> DataFrame:
    return trend(s.dated_sales(), [("order_year", "year_start")], OVERVIEW)


def month_label_overview(s: Star) -> DataFrame:
    return trend(s.dated_sales(), [("order_year", "month_label")], OVERVIEW)


def new_customers_by_year(s: Star) -> DataFrame:
    return new_entities(s.dim_customers, "year_created", "year")


def new_customers_by_year_bucket(s: Star) -> DataFrame:
    return new_entities(s.dim_customers, "year_created", "year_start")


# --- cumulative -------------------------------------------------------------

def preview_fact(s: Star) -> DataFrame:
    # ordered by every column, so that the ten rows are the same each time
    return rows.preview(s.fact_sales, 10, s.fact_sales.columns)


def monthly_sales(s: Star) -> DataFrame:
    return cum.period_totals(s.dated_sales(), "order_month").orderBy("order_month")


def running_monthly_sales(s: Star) -> DataFrame:
    return cum.running_sales(s.dated_sales(), "order_month")


def running_monthly_sales_by_order_date(s: Star) -> DataFrame:
    return cum.running_sales(s.dated_sales(), "order_date")


def running_qty_by_ship_month(s: Star) -> DataFrame:
    return cum.running_quantity_shipped(s.fact_sales)


def running_degenerate_partition(s: Star) -> DataFrame:
    return cum.running_sales(s.dated_sales(), "order_date", partition_by_period=True)


def running_sales_reset_yearly(s: Star) -> DataFrame:
    return cum.running_sales(s.dated_sales(), "order_date", reset_by=F.year)


def running_yearly_with_avg_price(s: Star) -> DataFrame:
    return cum.yearly_running_with_avg_price(s.dated_sales())


# --- performance ------------------------------------------------------------

def product_yearly_sales(s: Star) -> DataFrame:
    series = perf.period_sales(s.dated_sales(), s.dim_products, "order_year", "year")
    return series.orderBy("product_name", "order_year")


def product_yoy(s: Star) -> DataFrame:
    return perf.yearly_performance(s.dated_sales(), s.dim_products)


def product_mom(s: Star) -> DataFrame:
    return perf.monthly_performance(s.dated_sales(), s.dim_products)


def product_mom_year_baseline(s: Star) -> DataFrame:
    return perf.monthly_performance(s.dated_sales(), s.dim_products, year_baseline=True)


def product_mom_year_baseline_consistent(s: Star) -> DataFrame:
    return perf.monthly_performance(
        s.dated_sales(), s.dim_products, year_baseline=True, label_against_year=True
    )


# --- segmentation -----------------------------------------------------------

def scan_products(s: Star) -> DataFrame:
    return s.dim_products


def cost_band_counts(s: Star) -> DataFrame:
    return seg.band_counts(s.dim_products, COST_EDGES)


def cost_band_rows(s: Star) -> DataFrame:
    return seg.band_rows(s.dim_products, COST_EDGES)


def scan_customers(s: Star) -> DataFrame:
    return s.dim_customers


def customer_segment_counts(s: Star) -> DataFrame:
    return seg.segment_counts(s.fact_sales, s.dim_customers, MIN_MONTHS, VIP_SPENDING)


# --- part to whole ----------------------------------------------------------

def null_date_sales(s: Star) -> DataFrame:
    # Same rows as rows.null_rows(s.fact_sales, "order_date"); on the
    # year-partitioned gold fact only the NULL-year folder is read.
    return s.undated_sales()


def preview_products(s: Star) -> DataFrame:
    return rows.preview(s.dim_products, 5, ["product_key"])


def _category_totals(s: Star) -> DataFrame:
    return ctb.part_totals(s.fact_sales, s.dim_products, "product_key", "product_key", ["category"])


def category_sales(s: Star) -> DataFrame:
    return _category_totals(s).orderBy(F.col("category").asc_nulls_first())


def overall_sales(s: Star) -> DataFrame:
    return ctb.overall_total(s.fact_sales)


def category_contribution(s: Star) -> DataFrame:
    return ctb.contribution(_category_totals(s), places=2, sort_by="measure")


def customer_contribution(s: Star) -> DataFrame:
    parts = ctb.part_totals(
        s.fact_sales,
        s.dim_customers,
        "customer_key",
        "customer_key",
        ["customer_key", "first_name", "last_name"],
    )
    return ctb.contribution(
        parts, places=4, label="percentage_to_total_contribution", sort_by="label"
    )


# --- reports ----------------------------------------------------------------

def report_products(s: Star) -> DataFrame:
    return rep.report_products(s.dated_sales(), s.dim_products, AS_OF, HIGH_PERFORMER, MID_RANGE)


def preview_report_products(s: Star) -> DataFrame:
    # The report's first rows by key, unknown products last; only the 10 keys
    # shown are aggregated.
    return rep.preview_report_products(
        s.dated_sales(), s.dim_products, 10, AS_OF, high=HIGH_PERFORMER, mid=MID_RANGE
    )


def report_customers(s: Star) -> DataFrame:
    return rep.report_customers(s.dated_sales(), s.dim_customers, AS_OF, MIN_MONTHS, VIP_SPENDING)


def customers_aged_30_39(s: Star) -> DataFrame:
    # Same rows as filtering the full report; the age filter is applied to
    # the customer dimension before the fact is aggregated.
    return rep.report_customers(
        s.dated_sales(), s.dim_customers, AS_OF, MIN_MONTHS, VIP_SPENDING, age_range=(30, 39)
    )


def age_group_summary(s: Star) -> DataFrame:
    # Same rows as summarising the report, which needs only sums of it.
    return rep.age_group_totals(s.dated_sales(), s.dim_customers, AS_OF)


# --- reports read by name -----------------------------------------------------

def view_report_products(s: Star) -> DataFrame:
    return publish_report(report_products(s), "starlens_report_products")


def view_customers_aged_30_39(s: Star) -> DataFrame:
    publish_report(report_customers(s), "starlens_report_customers")
    reader = s.fact_sales.sparkSession
    return reader.sql("SELECT * FROM starlens_report_customers WHERE customer_age BETWEEN 30 AND 39")


def view_age_group_summary(s: Star) -> DataFrame:
    return rep.age_group_summary(publish_report(report_customers(s), "starlens_report_customers"))


# --- the reference's own bounds -------------------------------------------------

def cost_band_counts_reference_bounds(s: Star) -> DataFrame:
    return seg.band_counts(s.dim_products)


def customer_segment_counts_reference_bounds(s: Star) -> DataFrame:
    return seg.segment_counts(s.fact_sales, s.dim_customers)


def report_products_reference_bounds(s: Star) -> DataFrame:
    return rep.report_products(s.dated_sales(), s.dim_products, AS_OF)


def report_customers_reference_bounds(s: Star) -> DataFrame:
    return rep.report_customers(s.dated_sales(), s.dim_customers, AS_OF)


# --- at order-line grain: running sums without a one-task window ---------------------

_LINE = ["order_number", "product_key", "order_date", "sales_amount"]


def running_line_sales(s: Star) -> DataFrame:
    lines = s.dated_sales().select(*_LINE, "price")
    out = running_rows(lines, "order_date", {"running_total": "sales_amount"}, {"moving_avg_price": "price"})
    return out.select(*_LINE, "running_total", "moving_avg_price")


def running_line_sales_reset_yearly(s: Star) -> DataFrame:
    lines = s.dated_sales().select(*_LINE)
    return running_rows(lines, "order_date", {"running_total": "sales_amount"}, partition_by=F.year("order_date"))


def running_line_qty_by_ship_date(s: Star) -> DataFrame:
    lines = s.fact_sales.select("order_number", "product_key", "shipping_date", "quantity")
    return running_rows(lines, "shipping_date", {"running_qty": "quantity"})


# --- from the summary lattice ------------------------------------------------------

_LATTICES: dict[tuple[str, str], Lattice] = {}


def lattice(s: Star) -> Lattice:
    """The lattice of the star's input version, built and published when there is none; without a version, one that stores nothing."""
    if s.version is None:
        return Lattice(s)
    spark = s.fact_sales.sparkSession
    memo = (spark.sparkContext.applicationId, s.version)
    if memo not in _LATTICES:
        _LATTICES[memo] = fresh_lattice(spark, s, f"{writable_root(spark)}/starlens/lattice/{s.version}", s.version)
    return _LATTICES[memo]


def lattice_seasonal_month_sales(s: Star) -> DataFrame:
    return lattice(s).trend([("order_month", "month_number")], ["total_sales"])


def lattice_yearly_overview(s: Star) -> DataFrame:
    return lattice(s).trend([("order_year", "year")])


def lattice_seasonal_month_overview(s: Star) -> DataFrame:
    return lattice(s).trend([("order_month", "month_number")])


def lattice_year_month_overview(s: Star) -> DataFrame:
    return lattice(s).trend([("order_year", "year"), ("order_month", "month_number")])


def lattice_month_bucket_overview(s: Star) -> DataFrame:
    return lattice(s).trend([("order_date", "month")])


def lattice_year_bucket_overview(s: Star) -> DataFrame:
    return lattice(s).trend([("order_year", "year_start")])


def lattice_month_label_overview(s: Star) -> DataFrame:
    return lattice(s).trend([("order_year", "month_label")])


def lattice_monthly_sales(s: Star) -> DataFrame:
    return lattice(s).monthly().orderBy("order_month")


def lattice_running_monthly_sales(s: Star) -> DataFrame:
    return lattice(s).running_sales()


def lattice_running_monthly_sales_by_order_date(s: Star) -> DataFrame:
    return lattice(s).running_sales("order_date")


def lattice_running_qty_by_ship_month(s: Star) -> DataFrame:
    return lattice(s).running_quantity_shipped()


def lattice_running_degenerate_partition(s: Star) -> DataFrame:
    return lattice(s).running_sales("order_date", partition_by_period=True)


def lattice_running_sales_reset_yearly(s: Star) -> DataFrame:
    return lattice(s).running_sales("order_date", reset_by=F.year)


def lattice_running_yearly_with_avg_price(s: Star) -> DataFrame:
    return lattice(s).yearly_running_with_avg_price()


def lattice_product_yearly_sales(s: Star) -> DataFrame:
    return lattice(s).product_sales().orderBy("product_name", "order_year")


# --- distinct counts from bitmaps ----------------------------------------------------

def bitmap_report_products(s: Star) -> DataFrame:
    return rep.report_products_from_bitmaps(s.dated_sales(), s.dim_products, AS_OF, HIGH_PERFORMER, MID_RANGE)


def bitmap_report_customers(s: Star) -> DataFrame:
    return rep.report_customers_from_bitmaps(s.dated_sales(), s.dim_customers, AS_OF, MIN_MONTHS, VIP_SPENDING)


# --- grain keys from a membership filter ---------------------------------------------

def known_report_products(s: Star) -> DataFrame:
    return rep.report_products_by_known_keys(s.dated_sales(), s.dim_products, AS_OF, HIGH_PERFORMER, MID_RANGE)


def known_report_customers(s: Star) -> DataFrame:
    return rep.report_customers_by_known_keys(s.dated_sales(), s.dim_customers, AS_OF, MIN_MONTHS, VIP_SPENDING)


# --- from the co-partitioned layout ----------------------------------------------------

def copartitioned(s: Star, key: str) -> CoPartitioned:
    """The layout of the star's input version by ``key``, written when there is none; a star without a version gets a new one."""
    dim = s.dim_products if key == "product_key" else s.dim_customers
    spark = s.fact_sales.sparkSession
    root = f"{s.root or f'{writable_root(spark)}/starlens/unwritten'}/by_{key}"
    layout = open_copartitioned(spark, root) if s.root else None
    if layout is None:
        write_copartitioned(s.fact_sales, dim, key, root)
        layout = open_copartitioned(spark, root)
    return layout


def copartitioned_report_products(s: Star) -> DataFrame:
    by = copartitioned(s, "product_key")
    return rep.report_products_copartitioned(by.sales, by.apart, GRAIN, by.dimension, AS_OF, HIGH_PERFORMER, MID_RANGE)


def copartitioned_report_customers(s: Star) -> DataFrame:
    by = copartitioned(s, "customer_key")
    return rep.report_customers_copartitioned(by.sales, by.apart, GRAIN, by.dimension, AS_OF, MIN_MONTHS, VIP_SPENDING)


def copartitioned_product_yearly_sales(s: Star) -> DataFrame:
    sales = copartitioned(s, "product_key").joined("product_name").where(F.col("order_date").isNotNull())
    rows = sales.groupBy(F.year("order_date").alias("order_year"), "product_name").agg(F.sum("sales_amount").alias("current_sales"))
    return rows.orderBy("product_name", "order_year")


# --- incremental refresh ----------------------------------------------------------------

def _state(s: Star) -> inc.ReportState:
    """The report state of the written star's sales, with the files that were not folded in yet."""
    spark, root = s.fact_sales.sparkSession, s.root
    if root is None:  # a star that isn't written has no files to fold in
        root = f"{writable_root(spark)}/starlens/folded"
        write_star(s, root)
    return inc.refresh(spark, f"{build_folder(root, published(spark, root))}/fact_sales", f"{root}/report_state")


def incremental_report_products(s: Star) -> DataFrame:
    return _state(s).report_products(s.dim_products, AS_OF, high=HIGH_PERFORMER, mid=MID_RANGE)


def incremental_report_customers(s: Star) -> DataFrame:
    return _state(s).report_customers(s.dim_customers, AS_OF, min_months=MIN_MONTHS, vip_spending=VIP_SPENDING)


# --- live catalog views ---------------------------------------------------------------

def _live(s: Star, report: str) -> DataFrame:
    """A read of the live report view over the star's catalogued tables."""
    spark = s.fact_sales.sparkSession
    root, prefix = s.root, f"starlens_{s.version}_"
    if root is None:  # a star that isn't written has no folder to catalog
        root, prefix = f"{writable_root(spark)}/starlens/live", "starlens_live_"
        write_star(s, root)
    catalog_star(spark, root, prefix=prefix)
    bounds = {"high": HIGH_PERFORMER, "mid": MID_RANGE, "min_months": MIN_MONTHS, "vip_spending": VIP_SPENDING}
    names = create_live_reports(spark, AS_OF, prefix=prefix, **bounds)
    return read_view(spark, next(n for n in names if report in n))


def live_report_products(s: Star) -> DataFrame:
    return _live(s, "report_products")


def live_report_customers(s: Star) -> DataFrame:
    return _live(s, "report_customers")


def live_age_group_summary(s: Star) -> DataFrame:
    return rep.age_group_summary(_live(s, "report_customers"))


_BY_STAR = [
    seasonal_month_sales,
    yearly_overview,
    seasonal_month_overview,
    year_month_overview,
    month_bucket_overview,
    year_bucket_overview,
    month_label_overview,
    new_customers_by_year,
    new_customers_by_year_bucket,
    preview_fact,
    monthly_sales,
    running_monthly_sales,
    running_monthly_sales_by_order_date,
    running_qty_by_ship_month,
    running_degenerate_partition,
    running_sales_reset_yearly,
    running_yearly_with_avg_price,
    product_yearly_sales,
    product_yoy,
    product_mom,
    product_mom_year_baseline,
    product_mom_year_baseline_consistent,
    scan_products,
    cost_band_counts,
    cost_band_rows,
    scan_customers,
    customer_segment_counts,
    null_date_sales,
    preview_products,
    category_sales,
    overall_sales,
    category_contribution,
    customer_contribution,
    report_products,
    preview_report_products,
    report_customers,
    customers_aged_30_39,
    age_group_summary,
    view_report_products,
    view_customers_aged_30_39,
    view_age_group_summary,
    cost_band_counts_reference_bounds,
    customer_segment_counts_reference_bounds,
    report_products_reference_bounds,
    report_customers_reference_bounds,
    running_line_sales,
    running_line_sales_reset_yearly,
    running_line_qty_by_ship_date,
    lattice_seasonal_month_sales,
    lattice_yearly_overview,
    lattice_seasonal_month_overview,
    lattice_year_month_overview,
    lattice_month_bucket_overview,
    lattice_year_bucket_overview,
    lattice_month_label_overview,
    lattice_monthly_sales,
    lattice_running_monthly_sales,
    lattice_running_monthly_sales_by_order_date,
    lattice_running_qty_by_ship_month,
    lattice_running_degenerate_partition,
    lattice_running_sales_reset_yearly,
    lattice_running_yearly_with_avg_price,
    lattice_product_yearly_sales,
    bitmap_report_products,
    bitmap_report_customers,
    known_report_products,
    known_report_customers,
    copartitioned_report_products,
    copartitioned_report_customers,
    copartitioned_product_yearly_sales,
    incremental_report_products,
    incremental_report_customers,
    live_report_products,
    live_report_customers,
    live_age_group_summary,
]

QUERIES: dict[str, Query] = {fn.__name__: _star(fn) for fn in _BY_STAR}
BY_STAR: dict[str, Callable[[Star], DataFrame]] = {fn.__name__: fn for fn in _BY_STAR}

FLAGSHIP = "report_customers"
