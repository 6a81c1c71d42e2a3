"""Live report views: re-evaluated on every read, in any session of the catalog."""

import datetime

import pytest
from pyspark.sql import functions as F

from starlens.operators import reports as rep
from starlens.plans.explain import plan_text
from starlens.sources.live_views import catalog_star, create_live_reports, drop_live_reports, read_view
from starlens.sources.star import read_star, write_star
from tests.test_distinct_bitmaps import rows_of
from tests.test_lattice import awkward

AS_OF = datetime.date(2023, 1, 1)


@pytest.fixture
def gold(spark, scratch):
    """A flat gold layer that sales are appended to."""
    star = awkward(spark)
    star.fact_sales.write.parquet(f"{scratch}/fact_sales")
    star.dim_products.write.parquet(f"{scratch}/dim_products")
    star.dim_customers.write.parquet(f"{scratch}/dim_customers")
    return scratch


def test_new_sales_are_in_another_sessions_next_read(spark, gold):
    catalog_star(spark, gold, database="live_gold")
    names = create_live_reports(spark, AS_OF, database="live_gold", high=40_000, mid=500, min_months=3, vip_spending=1000)
    other = spark.newSession()
    for _ in range(2):
        star = read_star(spark, gold)
        products = rep.report_products(star.fact_sales, star.dim_products, AS_OF, 40_000, 500)
        customers = rep.report_customers(star.fact_sales, star.dim_customers, AS_OF, 3, 1000)
        for session in (spark, other):
            got = read_view(session, names[0])
            assert got.schema.simpleString() == products.schema.simpleString()
            assert rows_of(got) == rows_of(products)
            assert rows_of(read_view(session, names[1])) == rows_of(customers)
        star.fact_sales.where("product_key = 1").withColumn("order_number", F.concat("order_number", F.lit("x"))).write.mode("append").parquet(f"{gold}/fact_sales")
    drop_live_reports(spark, "live_gold")
    assert not other.sql("SHOW VIEWS IN live_gold").collect()


def test_a_newly_published_star_is_picked_up(spark, scratch):
    star = awkward(spark)
    write_star(star, scratch)
    catalog_star(spark, scratch, prefix="picked_")
    products, _ = create_live_reports(spark, AS_OF, prefix="picked_")
    before = read_view(spark, products).agg(F.sum("total_qty")).first()[0]
    write_star(cat_union(star), scratch)
    catalog_star(spark, scratch, prefix="picked_")
    assert read_view(spark, products).agg(F.sum("total_qty")).first()[0] == 2 * before
    drop_live_reports(spark, prefix="picked_")


def cat_union(star):
    from dataclasses import replace

    return replace(star, fact_sales=star.fact_sales.unionByName(star.fact_sales))


def test_the_current_date_is_taken_at_each_read(spark, gold):
    catalog_star(spark, gold, prefix="today_")
    products, customers = create_live_reports(spark, prefix="today_")
    star = read_star(spark, gold)
    assert rows_of(read_view(spark, products)) == rows_of(rep.report_products(star.fact_sales, star.dim_products))
    assert rows_of(read_view(spark, customers)) == rows_of(rep.report_customers(star.fact_sales, star.dim_customers))
    drop_live_reports(spark, prefix="today_")


def test_unknown_parameters_are_refused(spark):
    with pytest.raises(TypeError):
        create_live_reports(spark, hihg=3)


@pytest.mark.parametrize("report", ["report_products", "report_customers"])
def test_no_view_expands_the_sales(spark, gold, report):
    catalog_star(spark, gold, prefix="slim_")
    names = create_live_reports(spark, AS_OF, prefix="slim_")
    view = next(n for n in names if report in n)
    assert "Expand" not in plan_text(read_view(spark, view))
    drop_live_reports(spark, prefix="slim_")


def test_dimension_rows_of_one_key_count_each(spark, scratch):
    """Rows of a key that differ and rows that repeat: the sums of a tuple count once per row of the tuple."""
    star = awkward(spark)
    more = star.dim_products.unionByName(star.dim_products).unionByName(star.dim_products.withColumn("category", F.lit("other")))
    star.fact_sales.write.parquet(f"{scratch}/fact_sales")
    more.write.parquet(f"{scratch}/dim_products")
    star.dim_customers.write.parquet(f"{scratch}/dim_customers")
    catalog_star(spark, scratch, prefix="each_")
    products, _ = create_live_reports(spark, AS_OF, prefix="each_")
    f, p = (spark.read.parquet(f"{scratch}/{t}") for t in ("fact_sales", "dim_products"))
    joined = f.where("order_date is not null").join(p.withColumnRenamed("product_key", "own"), F.col("product_key") == F.col("own"), "left")
    want = joined.groupBy("own", "category").agg(
        F.sum("sales_amount"), F.sum("quantity").cast("long"), F.count_distinct("order_number"), F.count_distinct("customer_key")
    )
    got = read_view(spark, products).groupBy("product_key", "category").agg(
        F.sum("total_sales"), F.sum("total_qty"), F.max("total_orders"), F.max("total_customers")
    )
    assert rows_of(got) == rows_of(want)
    drop_live_reports(spark, prefix="each_")
