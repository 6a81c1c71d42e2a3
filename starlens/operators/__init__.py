"""User-level operators: DataFrame -> DataFrame functions over the star schema."""

from starlens.operators.part_to_whole import contribution, overall_total, part_totals
from starlens.operators.cumulative import (
    expanding_avg,
    period_totals,
    running_quantity_shipped,
    running_sales,
    running_total,
    yearly_running_with_avg_price,
)
from starlens.operators.distinct_bitmaps import dense_codes, set_words
from starlens.operators.inspect_rows import null_rows, preview
from starlens.operators.lattice import Lattice, build_lattice, fresh_lattice, open_lattice
from starlens.operators.prefix_scan import prefix_sums, running_rows
from starlens.operators.performance import (
    benchmark,
    monthly_performance,
    period_sales,
    yearly_performance,
)
from starlens.operators.reports import (
    age_group_summary,
    age_group_totals,
    customers_in_age_range,
    preview_report_products,
    register_reports,
    report_customers,
    report_customers_from_bitmaps,
    report_products,
    report_products_from_bitmaps,
)
from starlens.operators.segmentation import (
    band_counts,
    band_rows,
    cost_bands,
    customer_spending,
    loyalty_segment,
    segment_counts,
    segment_customers,
)
from starlens.operators.change_over_time import new_entities, trend

__all__ = [
    "Lattice",
    "build_lattice",
    "dense_codes",
    "fresh_lattice",
    "open_lattice",
    "prefix_sums",
    "running_rows",
    "report_customers_from_bitmaps",
    "report_products_from_bitmaps",
    "set_words",
    "age_group_summary",
    "age_group_totals",
    "band_counts",
    "band_rows",
    "benchmark",
    "contribution",
    "cost_bands",
    "customer_spending",
    "customers_in_age_range",
    "expanding_avg",
    "loyalty_segment",
    "monthly_performance",
    "new_entities",
    "null_rows",
    "overall_total",
    "part_totals",
    "period_sales",
    "period_totals",
    "preview",
    "preview_report_products",
    "register_reports",
    "report_customers",
    "report_products",
    "running_quantity_shipped",
    "running_sales",
    "running_total",
    "segment_counts",
    "segment_customers",
    "trend",
    "yearly_performance",
    "yearly_running_with_avg_price",
]
