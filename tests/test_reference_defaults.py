"""The operators' defaults are the reference's own values.

The registered queries pass thresholds scaled to the test data; a user who
calls the operators without parameters gets the reference's rules.
"""

import inspect

from starlens.functions.classify import band_labels
from starlens.operators import performance, reports, segmentation


def default(fn, name):
    return inspect.signature(fn).parameters[name].default


def test_segmentation_defaults():
    assert segmentation.REFERENCE_COST_EDGES == (100, 500, 1000)
    assert band_labels(segmentation.REFERENCE_COST_EDGES) == ["Below 100", "100-500", "500-1000", "Above 1000"]
    assert default(segmentation.band_counts, "edges") == (100, 500, 1000)
    assert default(segmentation.segment_counts, "min_months") == 12
    assert default(segmentation.segment_counts, "vip_spending") == 5000
    assert (segmentation.VIP, segmentation.REGULAR, segmentation.NEW) == ("VIP", "Regular", "New")


def test_report_defaults():
    assert default(reports.report_products, "high") == 50000
    assert default(reports.report_products, "mid") == 10000
    assert default(reports.report_customers, "min_months") == 12
    assert default(reports.report_customers, "vip_spending") == 5000
    assert default(reports.report_customers, "as_of") is None  # the current date, as the reference
    assert [g[0] for g in reports.AGE_GROUPS] + [reports.AGE_GROUP_DEFAULT] == [
        "Under 20", "20 to 29", "30 to 39", "40 to 49", "50 and above",
    ]
    assert reports.PRODUCT_REPORT_COLUMNS[-2:] == ["AOR", "AMR"]
    assert reports.CUSTOMER_REPORT_COLUMNS[-2:] == ["AVO", "AMS"]


def test_benchmark_defaults():
    assert default(performance.benchmark, "avg_mode") == "truncate"
    assert default(performance.benchmark, "previous") == "PY_sales"
    assert (performance.ABOVE_AVERAGE, performance.BELOW_AVERAGE, performance.AT_AVERAGE) == (
        "Above average", "Below average", "Average",
    )
    assert (performance.INCREASE, performance.DECREASE, performance.NO_CHANGE) == ("Increase", "Decrease", "No change")


def test_report_columns_match_the_operators(spark):
    from starlens.plans import catalog as cat
    from tests.conftest import SF_SMALL

    s = cat.star(spark, SF_SMALL)
    assert reports.report_products(s.fact_sales, s.dim_products, cat.AS_OF).columns == reports.PRODUCT_REPORT_COLUMNS
    assert reports.report_customers(s.fact_sales, s.dim_customers, cat.AS_OF).columns == reports.CUSTOMER_REPORT_COLUMNS
