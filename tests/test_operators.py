"""Operator tests on hand-written micro-fixtures (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from starlens.operators import (
    age_group_summary,
    band_counts,
    band_rows,
    benchmark,
    contribution,
    customers_in_age_range,
    monthly_performance,
    new_entities,
    part_totals,
    preview,
    report_customers,
    report_products,
    running_quantity_shipped,
    running_sales,
    segment_counts,
    segment_customers,
    trend,
    yearly_performance,
    yearly_running_with_avg_price,
)
from tests.fixtures import collect, customers, fact, products, star


def test_m1_yearly_benchmark_golden(spark):
    # The reference's published output for one product (2012-2014).
    s = star(
        spark,
        [
            {"order_number": 1, "product_key": 1, "order_date": "2012-05-01", "sales_amount": 159},
            {"order_number": 2, "product_key": 1, "order_date": "2013-02-01", "sales_amount": 37000},
            {"order_number": 3, "product_key": 1, "order_date": "2013-09-01", "sales_amount": 683},
            {"order_number": 4, "product_key": 1, "order_date": "2014-01-10", "sales_amount": 1749},
        ],
        [{"product_key": 1, "product_name": "All-Purpose Bike Stand"}],
    )
    got = collect(yearly_performance(s.fact_sales, s.dim_products))
    assert got == [
        (2012, "All-Purpose Bike Stand", 159, 13197, -13038, "Below average", None, None, "No change"),
        (2013, "All-Purpose Bike Stand", 37683, 13197, 24486, "Above average", 159, 37524, "Increase"),
        (2014, "All-Purpose Bike Stand", 1749, 13197, -11448, "Below average", 37683, -35934, "Decrease"),
    ]


def test_m2_m5_report_lifespan_and_zero_lifespan_rules(spark):
    s = star(
        spark,
        [
            # product 1 / customer 1: first 2011-01-31, last 2011-02-01 -> lifespan 1
            {"order_number": 1, "product_key": 1, "customer_key": 1, "order_date": "2011-01-31", "sales_amount": 40, "quantity": 1},
            {"order_number": 2, "product_key": 1, "customer_key": 1, "order_date": "2011-02-01", "sales_amount": 60, "quantity": 1},
            # product 2 / customer 2: one order, sales 120, lifespan 0
            {"order_number": 3, "product_key": 2, "customer_key": 2, "order_date": "2011-03-05", "sales_amount": 120, "quantity": 1},
        ],
        [{"product_key": 1, "product_name": "P1"}, {"product_key": 2, "product_name": "P2"}],
        [{"customer_key": 1, "customer_number": "C1"}, {"customer_key": 2, "customer_number": "C2"}],
    )
    rp = {r["product_key"]: r for r in report_products(s.fact_sales, s.dim_products, "2011-12-31").collect()}
    assert rp[1]["lifespan"] == 1 and rp[1]["AMR"] == 100
    assert rp[2]["lifespan"] == 0 and rp[2]["AMR"] == 0  # product: 0 when lifespan is 0
    assert rp[2]["recency_in_months"] == 9
    rc = {r["customer_key"]: r for r in report_customers(s.fact_sales, s.dim_customers, "2011-12-31").collect()}
    assert rc[1]["lifespan"] == 1 and rc[1]["AMS"] == 100
    assert rc[2]["lifespan"] == 0 and rc[2]["AMS"] == 120  # customer: total_sales when lifespan is 0


def test_m4_m18_integer_division_and_missing_orders(spark):
    s = star(
        spark,
        [
            {"order_number": 1, "product_key": 1, "customer_key": 1, "order_date": "2011-01-01", "sales_amount": 3},
            {"order_number": 2, "product_key": 1, "customer_key": 1, "order_date": "2011-01-02", "sales_amount": 4},
            # customer 2 has sales but no order number at all
            {"order_number": None, "product_key": 1, "customer_key": 2, "order_date": "2011-01-02", "sales_amount": 10},
        ],
        [{"product_key": 1, "product_name": "P"}],
        [{"customer_key": 1}, {"customer_key": 2}],
    )
    rc = {r["customer_key"]: r for r in report_customers(s.fact_sales, s.dim_customers, "2012-01-01").collect()}
    assert rc[1]["total_orders"] == 2 and rc[1]["total_sales"] == 7 and rc[1]["AVO"] == 3
    assert rc[2]["total_orders"] == 0 and rc[2]["AVO"] is None
    rp = report_products(s.fact_sales, s.dim_products, "2012-01-01").first()
    assert rp["total_orders"] == 2 and rp["total_sales"] == 17 and rp["AOR"] == 8


def test_m9_m10_null_dates_and_unknown_keys(spark):
    s = star(
        spark,
        [
            # customer 1: all order dates NULL -> New in segmentation, absent from the report
            {"order_number": 1, "customer_key": 1, "order_date": None, "sales_amount": 999999},
            # customer 2: long history, big spend
            {"order_number": 2, "customer_key": 2, "order_date": "2010-01-01", "sales_amount": 6000},
            {"order_number": 3, "customer_key": 2, "order_date": "2011-06-01", "sales_amount": 10},
            # unknown customer 77: grouped under the NULL dimension key
            {"order_number": 4, "customer_key": 77, "order_date": "2010-01-01", "sales_amount": 5},
            {"order_number": 5, "customer_key": 77, "order_date": "2012-01-01", "sales_amount": 5},
        ],
        customer_rows=[{"customer_key": 1, "first_name": "A", "last_name": "B"}, {"customer_key": 2}],
    )
    segs = {r["customer_key"]: r["customer_segment"] for r in segment_customers(s.fact_sales, s.dim_customers).collect()}
    assert segs == {1: "New", 2: "VIP", None: "Regular"}
    counts = dict(collect(segment_counts(s.fact_sales, s.dim_customers), "customer_segment", "total_customers"))
    assert counts == {"New": 1, "VIP": 1, "Regular": 0}  # the NULL-key group counts 0
    report_keys = {r["customer_key"] for r in report_customers(s.fact_sales, s.dim_customers, "2013-01-01").collect()}
    assert report_keys == {2, None}
    parts = part_totals(s.fact_sales, s.dim_customers, "customer_key", "customer_key", ["customer_key", "first_name", "last_name"])
    share = {r["customer_key"]: r["total_sales"] for r in contribution(parts, places=4).collect()}
    assert share == {1: 999999, 2: 6010, None: 10}


def test_m11_running_quantity_keeps_null_month_first(spark):
    s = star(
        spark,
        [
            {"shipping_date": None, "quantity": 1},
            {"shipping_date": "2011-01-03", "quantity": 2},
            {"shipping_date": "2011-02-20", "quantity": 1},
            {"shipping_date": "2011-02-21", "quantity": 2},
        ],
    )
    got = collect(running_quantity_shipped(s.fact_sales))
    assert [(r[1], r[2]) for r in got] == [(1, 1), (2, 3), (3, 6)]
    assert got[0][0] is None


def test_m12_running_total_resets(spark):
    s = star(
        spark,
        [
            {"order_date": "2010-12-05", "sales_amount": 5},
            {"order_date": "2011-01-10", "sales_amount": 3},
            {"order_date": "2011-01-20", "sales_amount": 4},
            {"order_date": "2011-02-01", "sales_amount": 1},
            {"order_date": None, "sales_amount": 100},
        ],
    )
    f = s.fact_sales
    assert [r[2] for r in collect(running_sales(f), order=["order_month"])] == [5, 12, 13]
    assert [r[2] for r in collect(running_sales(f, "order_date", reset_by=F.year), order=["order_date"])] == [5, 7, 8]
    degenerate = collect(running_sales(f, "order_date", partition_by_period=True), order=["order_date"])
    assert [r[2] for r in degenerate] == [5, 7, 1]
    assert all(r[1] == r[2] for r in degenerate)  # U7: result equals input


def test_m13_loyalty_segments(spark):
    s = star(
        spark,
        [
            {"customer_key": 1, "order_date": "2010-01-01", "sales_amount": 2500},
            {"customer_key": 1, "order_date": "2011-01-31", "sales_amount": 2500},
            {"customer_key": 2, "order_date": "2010-01-01", "sales_amount": 5001},
            {"customer_key": 2, "order_date": "2011-01-01", "sales_amount": 0},
            {"customer_key": 3, "order_date": "2010-01-01", "sales_amount": 9999},
            {"customer_key": 3, "order_date": "2010-12-31", "sales_amount": 0},
        ],
        customer_rows=[{"customer_key": k} for k in (1, 2, 3)],
    )
    got = dict(collect(segment_customers(s.fact_sales, s.dim_customers), "customer_key", "customer_segment"))
    assert got == {1: "Regular", 2: "VIP", 3: "New"}


def test_m14_m15_product_segments_and_selling_price(spark):
    s = star(
        spark,
        [
            {"order_number": 1, "product_key": 1, "order_date": "2011-01-01", "sales_amount": 50000, "quantity": 1},
            {"order_number": 2, "product_key": 2, "order_date": "2011-01-01", "sales_amount": 50001, "quantity": 1},
            {"order_number": 3, "product_key": 3, "order_date": "2011-01-01", "sales_amount": 10000, "quantity": 1},
            {"order_number": 4, "product_key": 4, "order_date": "2011-01-01", "sales_amount": 9999, "quantity": 1},
            {"order_number": 5, "product_key": 5, "order_date": "2011-01-01", "sales_amount": 10, "quantity": 0},
            {"order_number": 6, "product_key": 5, "order_date": "2011-01-01", "sales_amount": 10, "quantity": 2},
        ],
        [{"product_key": k} for k in range(1, 6)],
    )
    rp = {r["product_key"]: r for r in report_products(s.fact_sales, s.dim_products, "2012-01-01").collect()}
    assert [rp[k]["product_segment"] for k in (1, 2, 3, 4)] == ["Mid-Range", "High-Performers", "Mid-Range", "Low-Performers"]
    assert rp[5]["avg_selling_price"] == 5.0


def test_m16_share_sort_numeric_vs_label(spark):
    parts = spark.createDataFrame([("a", 95), ("b", 101), ("c", 804)], "k string, total_sales long")
    by_share = [r["k"] for r in contribution(parts, places=1, sort_by="share").collect()]
    by_label = [r["k"] for r in contribution(parts, places=1, sort_by="label").collect()]
    labels = {r["k"]: r["percentage_of_total"] for r in contribution(parts, places=1).collect()}
    assert labels == {"a": "9.5%", "b": "10.1%", "c": "80.4%"}
    assert by_share == ["c", "b", "a"]
    assert by_label == ["a", "c", "b"]  # text order: '9.5%' > '80.4%' > '10.1%'


def test_m17_expanding_average_truncates(spark):
    s = star(
        spark,
        [
            {"order_date": "2011-03-01", "sales_amount": 1, "price": 3},
            {"order_date": "2012-03-01", "sales_amount": 1, "price": 4},
            {"order_date": "2012-04-01", "sales_amount": 1, "price": 5},
        ],
    )
    trunc = collect(yearly_running_with_avg_price(s.fact_sales), order=["order_date"])
    assert [r[3] for r in trunc] == [3, 3]  # yearly means 3 and 4 (4.5 truncated)
    exact = collect(yearly_running_with_avg_price(s.fact_sales, mode="exact"), order=["order_date"])
    assert [r[3] for r in exact] == [3.0, 3.75]
    assert [r[2] for r in trunc] == [1, 3]


def test_m19_age_group_moves_with_as_of(spark):
    s = star(
        spark,
        [{"order_number": 1, "customer_key": 1, "order_date": "2020-01-01", "sales_amount": 1}],
        customer_rows=[{"customer_key": 1, "customer_number": "C1", "birthdate": "1985-06-01"}],
    )
    before = report_customers(s.fact_sales, s.dim_customers, "2024-12-31").first()
    after = report_customers(s.fact_sales, s.dim_customers, "2025-01-01").first()
    assert (before["customer_age"], before["age_groups"]) == (39, "30 to 39")
    assert (after["customer_age"], after["age_groups"]) == (40, "40 to 49")
    assert customers_in_age_range(report_customers(s.fact_sales, s.dim_customers, "2024-12-31")).count() == 1


def test_m20_year_baseline_as_written_and_consistent(spark):
    s = star(
        spark,
        [
            {"product_key": 1, "order_date": "2011-01-15", "sales_amount": 10},
            {"product_key": 1, "order_date": "2012-01-15", "sales_amount": 30},
        ],
        [{"product_key": 1, "product_name": "A"}],
    )
    as_written = collect(monthly_performance(s.fact_sales, s.dim_products, year_baseline=True))
    assert [(r[3], r[4]) for r in as_written] == [(10, -10), (30, 10)]
    consistent = collect(monthly_performance(s.fact_sales, s.dim_products, year_baseline=True, label_against_year=True))
    assert [(r[3], r[4], r[5]) for r in consistent] == [(10, 0, "Average"), (30, 0, "Average")]


def test_trend_and_new_entities(spark):
    s = star(
        spark,
        [
            {"customer_key": 1, "order_date": "2011-01-05", "sales_amount": 2, "quantity": 1},
            {"customer_key": 1, "order_date": "2012-01-05", "sales_amount": 3, "quantity": 1},
            {"customer_key": 2, "order_date": "2012-01-07", "sales_amount": 4, "quantity": 2},
            {"customer_key": 3, "order_date": None, "sales_amount": 100, "quantity": 9},
        ],
        customer_rows=[
            {"customer_key": 1, "create_date": "2010-05-05"},
            {"customer_key": 2, "create_date": "2010-06-05"},
            {"customer_key": None, "create_date": "2011-06-05"},
            {"customer_key": 4, "create_date": None},
        ],
    )
    seasonal = collect(trend(s.fact_sales, [("order_month", "month_number")]))
    assert seasonal == [(1, 9, 2, 4)]  # January of both years merged; NULL date dropped
    by_year = collect(new_entities(s.dim_customers))
    assert by_year == [(None, 1), (2010, 2), (2011, 0)]


def test_band_rows_match_band_counts(spark):
    p = products(spark, [{"product_key": k, "cost": c} for k, c in enumerate([50.0, 150.0, 160.0, None, 2000.0])])
    counts = dict(collect(band_counts(p), "cost_range", "total_products"))
    assert counts == {"Below 100": 1, "100-500": 2, "Above 1000": 2}
    for key, band, total in collect(band_rows(p), "product_key", "cost_range", "total_products"):
        assert counts[band] == total


def test_age_group_summary_counts_customer_numbers(spark):
    s = star(
        spark,
        [
            {"order_number": 1, "customer_key": 1, "order_date": "2020-01-01", "sales_amount": 5},
            {"order_number": 2, "customer_key": 99, "order_date": "2020-01-01", "sales_amount": 7},
        ],
        customer_rows=[{"customer_key": 1, "customer_number": "C1", "birthdate": "1950-01-01"}],
    )
    rep = report_customers(s.fact_sales, s.dim_customers, "2020-12-31")
    summary = dict((g, (n, t)) for g, n, t in collect(age_group_summary(rep)))
    # The unknown customer has no number and no age: counted 0 times, sales kept.
    assert summary == {"50 and above": (1, 12)}


def test_preview_orders_on_request(spark):
    f = fact(spark, [{"order_number": n, "sales_amount": n} for n in (5, 3, 9, 1)])
    assert [r["order_number"] for r in preview(f, 2, f.columns).collect()] == [1, 3]
    assert len(preview(f, 2).collect()) == 2


def test_benchmark_generic_entity(spark):
    series = spark.createDataFrame(
        [("x", 1, 10), ("x", 2, 10), ("y", 1, 5), ("y", 3, 1)], "region string, period int, current_sales long"
    )
    got = collect(benchmark(series, "region", "period"))
    assert got == [
        (1, "x", 10, 10, 0, "Average", None, None, "No change"),
        (2, "x", 10, 10, 0, "Average", 10, 0, "No change"),
        (1, "y", 5, 3, 2, "Above average", None, None, "No change"),
        (3, "y", 1, 3, -2, "Below average", 5, -4, "Decrease"),
    ]


def test_age_range_pushdown_equals_filtering_the_report(spark):
    from starlens.plans import catalog as cat
    from tests.conftest import SF_CHECK

    s = cat.star(spark, SF_CHECK)
    full = report_customers(s.fact_sales, s.dim_customers, cat.AS_OF, cat.MIN_MONTHS, cat.VIP_SPENDING)
    for low, high in [(30, 39), (-100, 19), (50, 200)]:
        pushed = report_customers(
            s.fact_sales, s.dim_customers, cat.AS_OF, cat.MIN_MONTHS, cat.VIP_SPENDING, age_range=(low, high)
        )
        assert sorted(map(str, pushed.collect())) == sorted(map(str, customers_in_age_range(full, low, high).collect()))


def test_preview_report_aggregates_only_the_shown_keys(spark):
    from starlens.operators import preview_report_products
    from starlens.plans import catalog as cat
    from tests.conftest import SF_CHECK

    s = cat.star(spark, SF_CHECK)
    for n in (1, 10, 25):
        fast = preview_report_products(s.fact_sales, s.dim_products, n, cat.AS_OF)
        report = report_products(s.fact_sales, s.dim_products, cat.AS_OF)
        slow = report.orderBy(F.col("product_key").asc_nulls_last()).limit(n)
        assert collect(fast) == collect(slow)
    # the unknown products' row comes last, and only when there is room for it
    few = s.dim_products.where("product_key <= 3")
    shown = preview_report_products(s.fact_sales, few, 10, cat.AS_OF)
    assert sorted(map(str, shown.collect())) == sorted(map(str, report_products(s.fact_sales, few, cat.AS_OF).collect()))
    assert shown.count() == 4
    # with no unknown products the NULL group is absent and keys start at the smallest
    known = s.fact_sales.join(s.dim_products.select("product_key"), "product_key", "left_semi")
    assert collect(preview_report_products(known, s.dim_products, 3, cat.AS_OF), "product_key")[0][0] is not None


def test_month_label_trend_text_or_chronological_order(spark):
    f = fact(
        spark,
        [{"order_date": d, "sales_amount": 1} for d in ("2011-01-05", "2011-02-05", "2011-04-05", "2010-12-05")],
    )
    text = [r[0] for r in collect(trend(f, [("order_year", "month_label")], ["total_sales"]))]
    chrono = [r[0] for r in collect(trend(f, [("order_year", "month_label")], ["total_sales"], chronological=True))]
    assert text == ["2010-Dec", "2011-Apr", "2011-Feb", "2011-Jan"]
    assert chrono == ["2010-Dec", "2011-Jan", "2011-Feb", "2011-Apr"]


def test_reports_expand_no_sales(spark):
    """Three rows a sale, each as wide as all measures, are never held by a task's partial aggregate."""
    from starlens.plans.explain import plan_text

    sales = fact(spark, [{"order_number": 1, "product_key": 1, "customer_key": 1, "order_date": "2020-01-01", "sales_amount": 5, "quantity": 1}])
    assert "Expand" not in plan_text(report_products(sales, products(spark, [{"product_key": 1}])))
    assert "Expand" not in plan_text(report_customers(sales, customers(spark, [{"customer_key": 1}])))
