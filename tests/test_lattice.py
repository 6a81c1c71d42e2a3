"""The summary lattice: routing, freshness, and equality with the statements over the fact."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starlens.operators import cumulative as cum
from starlens.operators import performance as perf
from starlens.operators.change_over_time import trend
from starlens.operators.lattice import CUSTOMERS, LEVELS, MONTH, PRODUCT, SHIP_MONTH, Lattice, build_lattice, fresh_lattice, open_lattice
from starlens.plans import catalog as cat
from starlens.plans.explain import plan_text
from starlens.sources.star import read_star, write_star
from tests.conftest import SF_SMALL
from tests.test_distinct_bitmaps import awkward_star, rows_of


def awkward(spark):
    fact, products, customers = awkward_star(spark)
    fact = fact.withColumn("shipping_date", F.date_add("order_date", 40)).withColumn("price", F.col("sales_amount") % 97)
    return cat.Star(fact.cache(), products, customers.withColumn("create_date", F.col("birthdate")))


def check_statements(star, lattice):
    dated = star.dated_sales()
    for by in ([("y", "year")], [("m", "month_number")], [("y", "year"), ("m", "month_number")], [("d", "month")], [("d", "year_start")], [("l", "month_label")]):
        assert lattice.trend(by).collect() == trend(dated, by).collect()
        assert lattice.trend(by, ["total_sales"]).collect() == trend(dated, by, ["total_sales"]).collect()
    assert rows_of(lattice.running_sales()) == rows_of(cum.running_sales(dated))
    assert rows_of(lattice.running_sales("d", reset_by=F.year)) == rows_of(cum.running_sales(dated, "d", reset_by=F.year))
    assert lattice.running_quantity_shipped().collect() == cum.running_quantity_shipped(star.fact_sales).collect()
    for mode in ("truncate", "exact"):
        assert rows_of(lattice.yearly_running_with_avg_price(mode)) == rows_of(cum.yearly_running_with_avg_price(dated, mode))
    for period, grain in (("order_year", "year"), ("order_month", "month")):
        want = perf.period_sales(dated, star.dim_products, period, grain)
        assert rows_of(lattice.product_sales(period, grain)) == rows_of(want)


def test_statements_equal_those_over_the_fact(spark, scratch):
    star = awkward(spark)
    check_statements(star, Lattice(star))  # nothing stored: computed from the fact
    check_statements(star, fresh_lattice(spark, star, scratch, "v1"))
    nothing = replace(star, fact_sales=star.fact_sales.limit(0))
    check_statements(nothing, fresh_lattice(spark, nothing, scratch, "v2"))


def test_router_takes_the_smallest_level_that_has_what_is_asked(spark, scratch):
    lattice = fresh_lattice(spark, awkward(spark), scratch, "v1")
    assert lattice.route([MONTH], ["total_sales"]) == "month"
    assert lattice.route([MONTH], ["total_sales", CUSTOMERS]) == "month_customers"
    assert lattice.route([MONTH, PRODUCT], ["total_qty"]) == "month_product"
    assert lattice.route([SHIP_MONTH], ["total_qty"]) == "ship_month"
    assert lattice.route([PRODUCT], [CUSTOMERS]) is None
    assert lattice.many["month"] <= lattice.many["month_product"]


def test_a_changed_input_is_never_answered_from_an_older_lattice(spark, scratch):
    star = awkward(spark)
    build_lattice(star, scratch, "v1")
    more = replace(star, fact_sales=star.fact_sales.unionByName(star.fact_sales.where("product_key = 1")))
    assert open_lattice(spark, more, scratch, "v2") is None
    newer = fresh_lattice(spark, more, scratch, "v2")
    check_statements(more, newer)
    assert newer.monthly().collect() != Lattice(star).monthly().collect()
    assert open_lattice(spark, star, scratch, "v1") is None  # superseded
    assert fresh_lattice(spark, more, scratch, "v2").stored.keys() == LEVELS.keys()


@pytest.mark.parametrize("key", [k for k in cat.QUERIES if k.startswith("lattice_")])
def test_registered_statements_read_summaries_only(spark, key):
    assert "fact_sales" not in plan_text(cat.QUERIES[key](spark, SF_SMALL))


def test_an_unversioned_star_is_answered_from_its_fact(spark, scratch):
    write_star(awkward(spark), scratch)
    star = read_star(spark, scratch)
    assert not cat.lattice(star).stored
    assert "fact_sales" in plan_text(cat.lattice(star).monthly())
