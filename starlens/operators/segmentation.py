"""Data segmentation: products by cost band, customers by spending and history.

Scale notes:

- Band counts are a grouped COUNT with map-side partial aggregation, so a
  band holding most products costs one partial row per task.
- The row-level variant (each product with its band's count) is *not* a
  window partitioned by band: with four bands that would put a quarter of
  the dimension into one task. Instead the counts (at most one row per
  band, a bound fixed by the rules) are broadcast and joined back.
- Customer spending sums the fact per customer key first (SUM/MIN/MAX are
  combined map-side), joins those per-customer rows to the dimension and
  re-aggregates by the dimension key, so unknown keys still merge into the
  NULL group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.functions.classify import first_match, range_band
from starlens.functions.dates import month_boundaries
from starlens.operators.preaggregate import dim_totals

# Fixed values of the reference: cost band edges, the loyalty rule and its labels
# (at least 12 months of history; spending above 5000 is VIP).
REFERENCE_COST_EDGES = (100, 500, 1000)
REFERENCE_MIN_MONTHS = 12
REFERENCE_VIP_SPENDING = 5000
VIP, REGULAR, NEW = "VIP", "Regular", "New"


def cost_bands(
    products: DataFrame,
    edges: Sequence[float] = REFERENCE_COST_EDGES,
    cost_col: str = "cost",
) -> DataFrame:
    """product_key, product_name, cost and its ``cost_range`` label."""
    return products.select(
        "product_key", "product_name", cost_col, range_band(cost_col, edges).alias("cost_range")
    )


def band_counts(
    products: DataFrame, edges: Sequence[float] = REFERENCE_COST_EDGES, sort: bool = True
) -> DataFrame:
    """COUNT(product_key) per cost band (NULL keys are not counted)."""
    out = (
        cost_bands(products, edges)
        .groupBy("cost_range")
        .agg(F.count("product_key").alias("total_products"))
    )
    return out.orderBy(F.col("total_products").desc()) if sort else out


def band_rows(
    products: DataFrame, edges: Sequence[float] = REFERENCE_COST_EDGES, sort: bool = True
) -> DataFrame:
    """Every product with its band and the band's product count.

    Same result as COUNT(product_key) OVER (PARTITION BY cost_range). The
    count table has at most ``len(edges) + 1`` rows, so broadcasting it is
    safe at any dimension size.
    """
    rows = cost_bands(products, edges)
    counts = band_counts(products, edges, sort=False)
    out = rows.join(F.broadcast(counts), "cost_range", "left").select(
        "product_key", "product_name", "cost", "cost_range", "total_products"
    )
    # total_products takes at most one value per band; the product key breaks
    # the ties so the range-partitioned sort can split a band across tasks.
    order = [F.col("total_products").desc(), F.col("cost_range"), F.col("product_key").asc_nulls_first()]
    return out.orderBy(*order) if sort else out


def loyalty_segment(
    lifespan: Column | str,
    spending: Column | str,
    min_months: int = REFERENCE_MIN_MONTHS,
    vip_spending: float = REFERENCE_VIP_SPENDING,
) -> Column:
    """VIP / Regular / New. NULL lifespan or spending falls through to ``New``."""
    life = F.col(lifespan) if isinstance(lifespan, str) else lifespan
    spend = F.col(spending) if isinstance(spending, str) else spending
    return first_match(
        [
            ((life >= min_months) & (spend > vip_spending), VIP),
            ((life >= min_months) & (spend <= vip_spending), REGULAR),
        ],
        NEW,
    )


def customer_spending(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer (dimension key): total spending, first/last order, lifespan in months.

    No date filter: sales without a date still count toward spending; a
    customer whose dates are all NULL has a NULL lifespan. Sales whose key
    is missing from the dimension group under a NULL key.
    """
    totals = dim_totals(
        fact,
        customers,
        "customer_key",
        "customer_key",
        [("customer_key", "customer_key")],
        [
            ("total_spending", "sum", "sales_amount"),
            ("first_order", "min", "order_date"),
            ("last_order", "max", "order_date"),
        ],
    )
    return totals.withColumn("lifespan", month_boundaries("first_order", "last_order"))


def segment_customers(
    fact: DataFrame,
    customers: DataFrame,
    min_months: int = REFERENCE_MIN_MONTHS,
    vip_spending: float = REFERENCE_VIP_SPENDING,
) -> DataFrame:
    """customer_key, total_spending, lifespan and customer_segment."""
    return customer_spending(fact, customers).select(
        "customer_key",
        "total_spending",
        "lifespan",
        loyalty_segment("lifespan", "total_spending", min_months, vip_spending).alias(
            "customer_segment"
        ),
    )


def segment_counts(
    fact: DataFrame,
    customers: DataFrame,
    min_months: int = REFERENCE_MIN_MONTHS,
    vip_spending: float = REFERENCE_VIP_SPENDING,
) -> DataFrame:
    """COUNT(customer_key) per segment; the NULL-key group is in a segment but counts 0."""
    return (
        segment_customers(fact, customers, min_months, vip_spending)
        .groupBy("customer_segment")
        .agg(F.count("customer_key").alias("total_customers"))
    )
