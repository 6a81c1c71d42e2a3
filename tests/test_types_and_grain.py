"""Division and averages by input type, and reports over any dimension."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starlens.operators import age_group_summary, age_group_totals, report_customers, report_products, yearly_performance
from starlens.operators.cumulative import yearly_running_with_avg_price
from tests.fixtures import star

FACT = [
    {"order_number": 1, "product_key": 1, "customer_key": 1, "order_date": "2011-01-05", "sales_amount": 5, "quantity": 2, "price": 5},
    {"order_number": 2, "product_key": 1, "customer_key": 1, "order_date": "2011-03-05", "sales_amount": 10, "quantity": 3, "price": 10},
    {"order_number": 3, "product_key": 2, "customer_key": 2, "order_date": "2012-03-05", "sales_amount": 5, "quantity": 1, "price": 5},
    {"order_number": 4, "product_key": 9, "customer_key": None, "order_date": "2012-03-05", "sales_amount": 7, "quantity": 1, "price": 7},
]
PRODUCTS = [{"product_key": 1, "product_name": "a"}, {"product_key": 2, "product_name": "b"}]
CUSTOMERS = [{"customer_key": 1, "customer_number": "C1"}, {"customer_key": 2, "customer_number": "C2"}]


def typed(spark, kind):
    s = star(spark, FACT, PRODUCTS, CUSTOMERS)
    quarter = lambda c: (F.col(c) / 4).cast(kind) if kind != "bigint" else F.col(c)
    return s.fact_sales.withColumns({"sales_amount": quarter("sales_amount"), "price": quarter("price")}), s


@pytest.mark.parametrize("kind", ["bigint", "decimal(18,2)", "double"])
def test_quotients_follow_the_type(spark, kind):
    fact, s = typed(spark, kind)
    whole = kind == "bigint"
    one = {r["product_key"]: r for r in report_products(fact, s.dim_products, "2013-01-01").collect()}[1]
    assert one["AOR"] == (7 if whole else Decimal("1.875") if kind.startswith("dec") else 1.875)
    assert float(one["AMR"]) == (7 if whole else 1.875)
    c = {r["customer_key"]: r for r in report_customers(fact, s.dim_customers, "2013-01-01").collect()}[1]
    assert float(c["AVO"]) == float(one["AOR"]) and float(c["AMS"]) == float(one["AMR"])
    years = yearly_running_with_avg_price(fact).collect()
    assert [float(r["moving_avg_price"]) for r in sorted(years)] == ([7, 6] if whole else [1.875, 1.6875])
    yoy = {r["product_name"]: r for r in yearly_performance(fact, s.dim_products).collect()}
    assert float(yoy["a"]["average_sales"]) == (15 if whole else 3.75)
    assert {r["avg_change"] for r in yoy.values()} == {"Average"}  # one period each


def test_single_period_decimal_is_average(spark):
    s = star(spark, [{"product_key": 1, "order_date": "2011-01-05", "sales_amount": 1}], PRODUCTS)
    fact = s.fact_sales.withColumn("sales_amount", F.lit(Decimal("1.25")).cast("decimal(10,2)"))
    row = yearly_performance(fact, s.dim_products).first()
    assert (float(row["average_sales"]), float(row["diff_avg"]), row["avg_change"]) == (1.25, 0.0, "Average")


def row_level_products(fact, dim):
    """The reference's statement: every sale joined to every dimension row of its key."""
    names = ["product_key", "product_name", "category", "subcategory", "cost"]
    joined = fact.where("order_date IS NOT NULL").withColumnRenamed("product_key", "fk").join(dim, F.col("fk") == F.col("product_key"), "left")
    return joined.groupBy(*names).agg(
        F.count_distinct("order_number").alias("total_orders"),
        F.sum("sales_amount").alias("total_sales"),
        F.sum("quantity").alias("total_qty"),
        F.count_distinct("customer_key").alias("total_customers"),
    )


def test_reports_are_exact_for_any_dimension(spark):
    dim = [*PRODUCTS, {"product_key": 2, "product_name": "b2"}, {"product_key": 1, "product_name": "a"}, {"product_key": None, "product_name": "none"}]
    s = star(spark, FACT, dim, [*CUSTOMERS, {"customer_key": 1, "customer_number": "C1"}, {"customer_key": 2, "customer_number": "C2b"}, {"customer_key": None, "customer_number": "C0"}])
    want = row_level_products(s.fact_sales, s.dim_products)
    got = report_products(s.fact_sales, s.dim_products, "2013-01-01").select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    report = report_customers(s.fact_sales, s.dim_customers, "2013-01-01")
    sums = sorted((r["customer_number"] or "", r["total_sales"], r["total_qty"], r["total_orders"]) for r in report.collect())
    assert sums == [("", 7, 1, 1), ("C1", 30, 10, 2), ("C2", 5, 1, 1), ("C2b", 5, 1, 1)]
    as_rows = lambda df: sorted(map(str, df.collect()))
    assert as_rows(age_group_totals(s.fact_sales, s.dim_customers, "2013-01-01")) == as_rows(age_group_summary(report))


def test_mean_price_doesnt_depend_on_partitioning(spark):
    rows = [
        (i, i % 5, i % 3, dt.date(2011, 1, 1 + i % 28), None, 1000 + 7 * i, 1 + i % 9, 1) for i in range(2000)
    ]
    s = star(spark, FACT, PRODUCTS)
    fact = spark.createDataFrame(rows, s.fact_sales.schema)
    dim = spark.range(5).select(F.col("id").alias("product_key"), *(F.lit(None).cast("string").alias(c) for c in ("product_name", "category", "subcategory")), F.lit(1.0).alias("cost"))
    prices = lambda n: sorted((r["product_key"], r["avg_selling_price"]) for r in report_products(fact.repartition(n), dim, "2013-01-01").collect())
    assert prices(1) == prices(3) == prices(7)
    exact = fact.groupBy("product_key").agg(F.avg(F.col("sales_amount") / F.col("quantity"))).collect()
    assert all(abs(a - b) <= 1e-12 * b for (_, a), (_, b) in zip(prices(1), sorted(map(tuple, exact)), strict=True))
