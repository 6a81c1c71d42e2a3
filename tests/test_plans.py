"""Plan-shape checks: what must hold for these queries to scale."""

import pytest

from starlens.operators import band_rows, preview, trend
from starlens.plans import catalog as cat
from starlens.plans.explain import (
    PAIR_NODES,
    PYTHON_NODES,
    count,
    node_details,
    plan_text,
    split_plan,
    tree,
)
from starlens.sources.star import YEAR_FOLDER, read_star, write_star
from tests.conftest import SF_SMALL


def main_tree(df):
    return tree(split_plan(plan_text(df))[0])


@pytest.mark.parametrize("key", sorted(cat.QUERIES))
def test_no_python_no_pairs(spark, key):
    text = plan_text(cat.QUERIES[key](spark, SF_SMALL))
    for node in PYTHON_NODES + PAIR_NODES:
        assert node not in text, f"{key} plans {node}"


def test_grand_total_never_moves_parts_to_one_task(spark):
    df = cat.QUERIES["customer_contribution"](spark, SF_SMALL)
    main, subs = split_plan(plan_text(df))
    # Per-customer rows are never sent to a single partition; only the
    # subquery's partial sums (one row per task) are.
    assert "SinglePartition" not in main
    assert "Window" not in tree(main)
    assert "SinglePartition" in subs
    df.collect()
    final = plan_text(df)
    assert "ReusedExchange" in final or "ReusedSubquery" in final


def test_yoy_windows_share_one_exchange_and_sort(spark):
    t = main_tree(cat.QUERIES["product_yoy"](spark, SF_SMALL))
    window_part = t.split("HashAggregate")[0]
    assert count(window_part, r"Window \(") == 2
    assert count(window_part, r"Sort \(") == 2  # one for both windows, one for ORDER BY
    assert count(window_part, r"Exchange \(") == 2  # hash on product_name, range for ORDER BY


def test_band_rows_broadcasts_the_bounded_count_table(spark):
    products = cat.star(spark, SF_SMALL).dim_products
    t = main_tree(band_rows(products, cat.COST_EDGES))
    assert "Window" not in t
    assert "BroadcastExchange" in t


def test_preview_is_top_n_not_full_sort(spark):
    fact = cat.star(spark, SF_SMALL).fact_sales
    t = main_tree(preview(fact, 10, fact.columns))
    assert "TakeOrderedAndProject" in t
    assert "Sort (" not in t
    plain = main_tree(preview(fact, 10))
    assert "CollectLimit" in plain
    assert "TakeOrdered" not in plain and "Exchange" not in plain


@pytest.fixture
def no_broadcast(spark):
    """Plans as for dimensions too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_preview_report_restricts_the_fact_by_its_own_key(spark):
    # The shown keys are a LIMIT result, whose bound the planner knows: no fact row is
    # shuffled before that semi-join, and no join above it is on the dimension's key.
    text = plan_text(cat.QUERIES["preview_report_products"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text
    semi = [b for b in node_details(text, "BroadcastHashJoin") if "LeftSemi" in b]
    assert semi and all("product_key" in b for b in semi)


def test_age_group_summary_aggregates_before_its_one_join(spark, no_broadcast):
    t = main_tree(cat.QUERIES["age_group_summary"](spark, SF_SMALL))
    assert count(t, r"Join") == 1
    assert count(t, r"Exchange \(") <= 4  # per-key totals, attributes (grouped, then by key), age groups
    below = t[t.index("Join"):]
    assert "HashAggregate" in below  # the fact's side is per-key rows


@pytest.mark.parametrize(("key", "sorts"), [("product_mom_year_baseline", 3), ("product_mom_year_baseline_consistent", 2)])
def test_year_baseline_shares_the_lag_sort(spark, key, sorts):
    window_part = main_tree(cat.QUERIES[key](spark, SF_SMALL)).split("HashAggregate")[0]
    assert count(window_part, r"Sort \(") <= sorts


def test_gold_star_pushes_filters_and_prunes_columns(spark, scratch):
    root = f"{scratch}/gold"
    write_star(cat.star(spark, SF_SMALL), root)
    gold = read_star(spark, root)
    df = trend(gold.fact_sales, [("order_month", "month")], ["total_sales"])
    scans = node_details(plan_text(df), "Scan parquet")
    assert len(scans) == 1
    scan = scans[0]
    assert "IsNotNull(order_date)" in scan
    read_schema = scan.split("ReadSchema:")[1].splitlines()[0]
    assert "order_date" in read_schema and "sales_amount" in read_schema
    assert "customer_key" not in read_schema and "price" not in read_schema


def test_year_filter_prunes_fact_partitions(spark, scratch):
    from pyspark.sql import functions as F

    root = f"{scratch}/gold"
    write_star(cat.star(spark, SF_SMALL), root)
    fact = read_star(spark, root).fact_by_year
    text = plan_text(fact.filter(F.col(YEAR_FOLDER) == 1995).select("sales_amount"))
    assert f"PartitionFilters: [isnotnull({YEAR_FOLDER}" in text


def test_cte_and_derived_table_forms_are_one_plan(spark):
    """The reference writes the running total twice (derived table, then CTE)."""
    from starlens.operators import running_sales

    star = cat.star(spark, SF_SMALL)
    star.register(prefix="u_")
    inner = """SELECT trunc(order_date, 'MM') AS order_month, SUM(sales_amount) AS total_sales
               FROM u_fact_sales WHERE month(order_date) IS NOT NULL
               GROUP BY trunc(order_date, 'MM')"""
    derived = spark.sql(
        f"SELECT order_month, total_sales, SUM(total_sales) OVER (ORDER BY order_month) AS running_total FROM ({inner}) z1"
    )
    cte = spark.sql(
        f"WITH x1 AS ({inner}) SELECT order_month, total_sales, SUM(total_sales) OVER (ORDER BY order_month) AS running_total FROM x1"
    )
    import re

    def shape(df):  # physical plan without expression ids and plan ids
        return re.sub(r"#\d+L?|plan_id=\d+", "", plan_text(df, "simple"))

    assert shape(derived) == shape(cte)
    ours = running_sales(star.fact_sales)
    key = lambda rows: sorted((r[0], r[1], r[2]) for r in rows)
    assert key(derived.collect()) == key(cte.collect()) == key(ours.collect())


@pytest.mark.parametrize("key", ["customer_contribution", "cost_band_rows"])
def test_large_sorts_break_ties(spark, key):
    """Sorts over one row per customer/product must not range-partition on a few values."""
    text = plan_text(cat.QUERIES[key](spark, SF_SMALL))
    ranges = [ln for ln in text.splitlines() if "rangepartitioning(" in ln]
    assert ranges
    expected = "customer_key" if key == "customer_contribution" else "product_key"
    assert all(expected in ln for ln in ranges), ranges


def test_month_labels_are_formatted_after_aggregation(spark):
    text = plan_text(cat.QUERIES["month_label_overview"](spark, SF_SMALL))
    agg_keys = [b for b in node_details(text, "HashAggregate")]
    assert agg_keys and not any("date_format" in b.split("Functions")[0] for b in agg_keys)
    assert "date_format" in text  # applied to the aggregated rows


def test_undated_sales_read_only_the_null_year_folder(spark):
    from starlens.operators import null_rows

    star = cat.star(spark, SF_SMALL)
    assert star.fact_by_year is not None
    df = star.undated_sales()
    scans = node_details(plan_text(df), "Scan parquet")
    assert any("PartitionFilters: [isnull(starlens_order_year" in b for b in scans), scans
    assert sorted(map(str, df.collect())) == sorted(map(str, null_rows(star.fact_sales, "order_date").collect()))


@pytest.mark.parametrize("key", ["month_bucket_overview", "report_customers", "product_yoy"])
def test_dated_queries_skip_the_null_year_folder(spark, key):
    scans = node_details(plan_text(cat.QUERIES[key](spark, SF_SMALL)), "Scan parquet")
    fact_scans = [b for b in scans if "fact_sales" in b]
    assert fact_scans and all("PartitionFilters: [isnotnull(starlens_order_year" in b for b in fact_scans)
