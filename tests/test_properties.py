"""Whole-table properties and the FIXTURES.md anchors at sf0.01."""

import pytest
from pyspark.sql import functions as F

from starlens.plans import catalog as cat
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def star(spark):
    return cat.star(spark, SF_CHECK)


def q(spark, key):
    return cat.QUERIES[key](spark, SF_CHECK)


def test_fixture_anchors(spark, star):
    f = star.fact_sales
    row = f.agg(
        F.count("*").alias("n"),
        F.count("order_date").alias("dated"),
        F.count("shipping_date").alias("shipped"),
        F.count("customer_key").alias("keyed"),
        F.sum(F.when(F.col("quantity") == 0, 1).otherwise(0)).alias("zero_qty"),
        F.sum("sales_amount").alias("sales"),
        F.sum("price").alias("price"),
    ).first()
    assert tuple(row) == (60000, 59414, 59367, 59302, 169, 3183226572, 285887510)
    segs = dict(q(spark, "customer_segment_counts").collect())
    assert segs == {"New": 6, "Regular": 692, "VIP": 787}
    prod = dict(q(spark, "report_products").groupBy("product_segment").count().collect())
    assert prod == {"Low-Performers": 405, "Mid-Range": 1106, "High-Performers": 480}
    bands = dict(q(spark, "cost_band_counts").collect())
    assert bands == {"Below 925": 492, "925-950": 495, "950-975": 493, "Above 975": 510}
    years = [r[1] for r in q(spark, "new_customers_by_year").collect()]
    assert years == [203, 203, 204, 203, 202, 202, 204, 79]


def test_running_total_ends_at_dated_total(spark, star):
    dated = star.fact_sales.filter(F.col("order_date").isNotNull()).agg(F.sum("sales_amount")).first()[0]
    rows = q(spark, "running_monthly_sales").collect()
    assert rows[-1]["running_total"] == dated
    assert all(a["running_total"] < b["running_total"] for a, b in zip(rows, rows[1:]))


def test_yearly_reset_ends_sum_to_total(spark, star):
    dated = star.fact_sales.filter(F.col("order_date").isNotNull()).agg(F.sum("sales_amount")).first()[0]
    rows = q(spark, "running_sales_reset_yearly").collect()
    last_per_year = {}
    for r in rows:
        last_per_year[r["order_date"].year] = r["running_total"]
    assert sum(last_per_year.values()) == dated


def test_degenerate_partition_equals_input(spark):
    rows = q(spark, "running_degenerate_partition").collect()
    assert rows and all(r["total_sales"] == r["running_total"] for r in rows)


def test_parts_sum_to_overall(spark):
    overall = q(spark, "overall_sales").first()[0]
    assert sum(r["total_sales"] for r in q(spark, "category_sales").collect()) == overall
    contrib = q(spark, "customer_contribution").collect()
    assert sum(r["total_sales"] for r in contrib) == overall
    assert {r["overall_sales"] for r in contrib} == {overall}
    assert any(r["customer_key"] is None for r in contrib)  # unmatched sales kept


def test_band_counts_cover_every_key(spark, star):
    total = sum(r[1] for r in q(spark, "cost_band_counts").collect())
    assert total == star.dim_products.filter(F.col("product_key").isNotNull()).count()


def test_age_summary_matches_report(spark):
    report = q(spark, "report_customers")
    summary = q(spark, "age_group_summary").collect()
    assert sum(r["total_sales"] for r in summary) == report.agg(F.sum("total_sales")).first()[0]
    assert sum(r["total_customers"] for r in summary) == report.filter(F.col("customer_number").isNotNull()).count()


def test_undated_sales_are_the_difference(spark, star):
    # Part-to-whole keeps undated sales; the report drops them (the reference's 4992 gap).
    overall = q(spark, "overall_sales").first()[0]
    report_total = q(spark, "report_customers").agg(F.sum("total_sales")).first()[0]
    undated = q(spark, "null_date_sales").agg(F.sum("sales_amount")).first()[0]
    assert overall - report_total == undated
