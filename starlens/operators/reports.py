"""Product and customer KPI reports (the reference's two report views).

Each report is a lazy DataFrame: register it as a view to re-evaluate it on
every read (the reference's view semantics) or :func:`materialize` it once
to shared storage so many readers share one computation.

Plan shape: fact (``IsNotNull(order_date)`` pushed into the scan) left-joined
to the dimension's keys (broadcast only under the planner's size
threshold, else sort-merge with AQE skew splitting; all unmatched sales share
the NULL key and so form one skewed partition) -> aggregate per key -> join
of the per-key rows to the dimension attributes, one row per distinct
attribute tuple with its number of rows. The sums and the two COUNT(DISTINCT)
measures are aggregated apart, without an ``Expand``, each reading its own columns;
a distinct count has two stages, of which the first shuffles on (key, distinct
column), so even a product or customer with a third of all sales is spread
across tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.functions.classify import first_match
from starlens.functions.dates import as_of_date, month_boundaries, year_boundaries
from starlens.functions.numeric import is_integral, quotient, ratio, stable_avg, stable_units, units_mean
from starlens.functions.text import full_name
from starlens.operators.distinct_bitmaps import BITS, coarser, set_words, with_code
from starlens.operators.known_keys import MOST_WORDS, grain_sales
from starlens.operators.segmentation import (
    REFERENCE_MIN_MONTHS,
    REFERENCE_VIP_SPENDING,
    loyalty_segment,
)

# Fixed values of the reference: product revenue segments (bounds and labels) and age groups.
REFERENCE_HIGH_PERFORMER = 50000  # total_sales above this: High-Performers
REFERENCE_MID_RANGE = 10000  # total_sales from this: Mid-Range
HIGH_PERFORMERS, MID_RANGE, LOW_PERFORMERS = "High-Performers", "Mid-Range", "Low-Performers"
AGE_GROUPS = (
    ("Under 20", None, 19),
    ("20 to 29", 20, 29),
    ("30 to 39", 30, 39),
    ("40 to 49", 40, 49),
)
AGE_GROUP_DEFAULT = "50 and above"

PRODUCT_REPORT_COLUMNS = [
    "product_key", "product_name", "category", "subcategory", "cost", "product_segment",
    "total_orders", "total_sales", "total_customers", "total_qty", "last_sale_date",
    "lifespan", "avg_selling_price", "recency_in_months", "AOR", "AMR",
]

CUSTOMER_REPORT_COLUMNS = [
    "customer_key", "customer_number", "customer_name", "customer_age", "age_groups",
    "customer_segment", "total_orders", "total_sales", "total_qty", "total_products",
    "last_order_date", "lifespan", "recency", "AVO", "AMS",
]


def product_segment(total_sales, high: float = REFERENCE_HIGH_PERFORMER, mid: float = REFERENCE_MID_RANGE):
    s = F.col(total_sales) if isinstance(total_sales, str) else total_sales
    return first_match([(s > high, HIGH_PERFORMERS), (s >= mid, MID_RANGE)], LOW_PERFORMERS)


def age_group(age):
    a = F.col(age) if isinstance(age, str) else age
    branches = []
    for label, lo, hi in AGE_GROUPS:
        branches.append((a <= hi if lo is None else a.between(lo, hi), label))
    return first_match(branches, AGE_GROUP_DEFAULT)


_DIM_KEY = "__grain_key"
_REPEATS = "__repeats"
_KEY_ROWS = "__key_rows"


def _dated(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("order_date").isNotNull())


def _keyed_sales(fact: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Dated sales with the grain key: the dimension key, NULL for unknown keys.

    A sale appears once for each dimension row of its key, usually one;
    :func:`_with_attributes` takes repeats out of the sums again. (Making the
    keys distinct first would put an aggregate between the shuffle and the
    join, and AQE could no longer split a hot key's partition.)
    """
    keys = dim.select(F.col(key).alias(_DIM_KEY))
    return _dated(fact).join(keys, F.col(key) == F.col(_DIM_KEY), how)


def _first_keys_sales(fact: DataFrame, dim: DataFrame, key: str, n: int) -> DataFrame:
    """The sales of the ``n`` smallest grain keys (NULL last), with their grain key.

    The keys come from the fact's distinct keys, so the fact is restricted by
    its own key before any join. Sales of unknown keys (the NULL group, last)
    are a branch of their own, whose rows pass only when there are fewer
    than ``n`` known keys; the planner sees the bound of the LIMIT and needs
    no hint.
    """
    dated = _dated(fact)
    known = dim.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    first = dated.select(key).distinct().join(known, key, "left_semi").orderBy(key).limit(n)
    own = dated.join(first, key, "left_semi").withColumn(_DIM_KEY, F.col(key))
    room = first.agg(F.count("*")).scalar() < F.lit(n)
    unknown = dated.filter(room).join(known, key, "left_anti").withColumn(_DIM_KEY, F.lit(None).cast(own.schema[_DIM_KEY].dataType))
    return own.unionByName(unknown)


def _grain_aggregates(base: DataFrame, key: str) -> DataFrame:
    """Report measures per grain key over dated sales (``base``, see :func:`_keyed_sales`).

    The grain is the dimension key: every other grain column of the
    reference (names, category, cost, age) is an attribute of that key. So
    the fact is joined to the dimension's *key column only*, aggregated per
    key, and the attributes are joined to the per-key rows afterwards
    (:func:`_with_attributes`). The fact-level join, the Expand of the two
    COUNT(DISTINCT) and their shuffles carry one key instead of several
    strings.
    """
    other_key, other_alias = _COUNTED[key]
    distinct = [F.count_distinct("order_number").alias("total_orders"), F.count_distinct(other_key).alias(other_alias)]
    return base.groupBy(_DIM_KEY).agg(*_plain_measures(key), *distinct)


def _plain_measures(key: str) -> list[Column]:
    """The measures of a report that are no distinct counts."""
    first, last = F.min("order_date"), F.max("order_date")
    measures = [
        F.sum("sales_amount").alias("total_sales"),
        F.sum("quantity").alias("total_qty"),
        last.alias("last_sale_date" if key == "product_key" else "last_order_date"),
        month_boundaries(first, last).alias("lifespan"),
    ]
    if key == "product_key":
        measures.append(stable_avg(ratio("sales_amount", "quantity")).alias("avg_selling_price"))
    return measures


def _slim_aggregates(base: DataFrame, key: str) -> DataFrame:
    """:func:`_grain_aggregates` without an ``Expand``, for a ``base`` that holds all sales.

    A task's partial aggregate of expanded rows holds three rows a sale, each as wide
    as all measures. Here the sums and either distinct count have an aggregate of their own,
    which reads its columns only and holds one narrow row a pair at most; one more
    aggregate lays a key's three rows together.
    """
    parts = [base.groupBy(_DIM_KEY).agg(*_plain_measures(key))]
    for column, alias in (("order_number", "total_orders"), _COUNTED[key]):
        parts.append(base.groupBy(_DIM_KEY).agg(F.count_distinct(column).alias(alias)))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # a key has one value of each measure, whatever its type
    return rows.groupBy(_DIM_KEY).agg(*(F.max(c).alias(c) for c in rows.columns if c != _DIM_KEY))


def _attributes(dim: DataFrame, key: str, columns: list[Column]) -> DataFrame:
    """The dimension's distinct grain tuples, with the numbers of rows of the tuple and of its key.

    In a join with the dimension's rows, the sums of a tuple count once per row
    of the tuple; distinct counts, extremes and means don't change.
    """
    rows = dim.where(F.col(key).isNotNull()).select(F.col(key).alias(_DIM_KEY), *columns)
    tuples = rows.groupBy(*rows.columns).agg(F.count("*").alias(_REPEATS))
    return tuples.withColumn(_KEY_ROWS, F.sum(_REPEATS).over(Window.partitionBy(_DIM_KEY)))


def _with_attributes(agg: DataFrame, attributes: DataFrame, how: str = "left", sales_repeated: bool = True) -> DataFrame:
    """Per-key measures with each attribute tuple of the key, sums scaled to the tuple's rows.

    ``sales_repeated``: the measures saw every sale once per dimension row of its key.
    """
    rows = agg.join(attributes, _DIM_KEY, how)
    seen = F.col(_KEY_ROWS) if sales_repeated else F.lit(1)

    def scaled(c: str) -> Column:
        # a sum keeps its type, which for decimals the product would widen
        whole = quotient(F.col(c) * F.col(_REPEATS), seen, is_integral(agg, c)).cast(agg.schema[c].dataType)
        return F.when(F.col(_REPEATS).isNull() | (F.col(_REPEATS) == seen), F.col(c)).otherwise(whole)

    return rows.withColumns({c: scaled(c) for c in ("total_sales", "total_qty")})


def report_products(
    fact: DataFrame,
    products: DataFrame,
    as_of=None,
    high: float = REFERENCE_HIGH_PERFORMER,
    mid: float = REFERENCE_MID_RANGE,
) -> DataFrame:
    """One row per product (dimension grain) with order, sales and recency KPIs.

    - ``avg_selling_price``: AVG(sales / NULLIF(quantity, 0)); zero-quantity
      lines leave the mean. The same for every partitioning (see
      :func:`starlens.functions.numeric.stable_avg`).
    - ``AOR``: 0 when total_sales is 0, else total_sales / total_orders.
    - ``AMR``: 0 when the lifespan is 0, else total_sales / lifespan.
    - ``recency_in_months``: month boundaries from the last sale to ``as_of``.

    Quotients of whole numbers are truncated.
    """
    agg = _slim_aggregates(_keyed_sales(fact, products, "product_key"), "product_key")
    return _product_report(agg, products, as_of, high, mid)


def _product_rows(
    base: DataFrame, products: DataFrame, as_of, high: float, mid: float, sales_repeated: bool = True
) -> DataFrame:
    """The product report over ``base``, sales with their grain key, in one pass over them."""
    agg = _grain_aggregates(base, "product_key")
    return _product_report(agg, products, as_of, high, mid, sales_repeated)


def _product_report(
    agg: DataFrame, products: DataFrame, as_of, high: float, mid: float, sales_repeated: bool = True
) -> DataFrame:
    """The product report from its measures per grain key."""
    today = as_of_date(as_of)
    names = ["product_key", "product_name", "category", "subcategory", "cost"]
    attributes = _attributes(products, "product_key", [F.col(c) for c in names])
    rows = _with_attributes(agg, attributes, sales_repeated=sales_repeated)
    sales, orders, life = F.col("total_sales"), F.col("total_orders"), F.col("lifespan")
    whole = is_integral(rows, "total_sales")
    return rows.select(
        *names,
        product_segment(sales, high, mid).alias("product_segment"),
        "total_orders", "total_sales", "total_customers", "total_qty", "last_sale_date",
        "lifespan", "avg_selling_price",
        month_boundaries("last_sale_date", today).alias("recency_in_months"),
        F.when(sales == 0, F.lit(0)).otherwise(quotient(sales, orders, whole)).alias("AOR"),
        F.when(life == 0, F.lit(0)).otherwise(quotient(sales, life, whole)).alias("AMR"),
    )


def _customer_attributes(customers: DataFrame, today) -> DataFrame:
    return _attributes(
        customers,
        "customer_key",
        [
            F.col("customer_key"),
            F.col("customer_number"),
            full_name("first_name", "last_name").alias("customer_name"),
            year_boundaries("birthdate", today).alias("customer_age"),
        ],
    )


def report_customers(
    fact: DataFrame,
    customers: DataFrame,
    as_of=None,
    min_months: int = REFERENCE_MIN_MONTHS,
    vip_spending: float = REFERENCE_VIP_SPENDING,
    age_range: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per customer (dimension grain) with age, loyalty and spend KPIs.

    ``age_range=(low, high)`` returns exactly the rows of the full report
    with ``low <= customer_age <= high``, but filters the customer dimension
    *before* the fact join: the age depends only on the dimension, and the
    NULL group of unknown customers has no age, so it never qualifies. The
    other customers' sales then never reach the aggregation or its shuffles.

    - ``customer_name``: first and last name joined by a space, NULL parts read as ''.
    - ``customer_age``: year boundaries from birthdate to ``as_of``.
    - ``AVO``: 0 when total_sales is 0, else total_sales / total_orders
      (NULL when there are sales but no order number at all).
    - ``AMS``: total_sales when the lifespan is 0, else total_sales / lifespan.

    Quotients of whole numbers are truncated.
    """
    today = as_of_date(as_of)
    how = "left"
    if age_range is not None:
        low, high = age_range
        customers = customers.filter(year_boundaries("birthdate", today).between(low, high))
        how = "inner"
    base = _keyed_sales(fact, customers, "customer_key", how)
    agg = _slim_aggregates(base, "customer_key")
    return _customer_report(agg, customers, today, min_months, vip_spending, how)


def _customer_report(
    agg: DataFrame,
    customers: DataFrame,
    today,
    min_months: int,
    vip_spending: float,
    how: str = "left",
    sales_repeated: bool = True,
) -> DataFrame:
    """The customer report from its measures per grain key."""
    rows = _with_attributes(agg, _customer_attributes(customers, today), how, sales_repeated)
    whole = is_integral(rows, "total_sales")
    # An unknown customer has no dimension row; its name still reads as ' '.
    name = F.coalesce(F.col("customer_name"), full_name(F.lit(None), F.lit(None)))
    sales, orders, life = F.col("total_sales"), F.col("total_orders"), F.col("lifespan")
    return rows.select(
        "customer_key", "customer_number", name.alias("customer_name"), "customer_age",
        age_group("customer_age").alias("age_groups"),
        loyalty_segment(life, sales, min_months, vip_spending).alias("customer_segment"),
        "total_orders", "total_sales", "total_qty", "total_products", "last_order_date",
        "lifespan",
        month_boundaries("last_order_date", today).alias("recency"),
        F.when(sales == 0, F.lit(0)).otherwise(quotient(sales, orders, whole)).alias("AVO"),
        F.when(life == 0, sales).otherwise(quotient(sales, life, whole)).alias("AMS"),
    )


#: Per grain key: the other column whose distinct values its report counts, and the count's name.
_COUNTED = {"product_key": ("customer_key", "total_customers"), "customer_key": ("product_key", "total_products")}


def _mergeable(key: str) -> dict[str, tuple[Column, Callable]]:
    """Measure -> (aggregate of sales, function that merges partial results)."""
    found = {
        "total_sales": (F.sum("sales_amount"), F.sum),
        "total_qty": (F.sum("quantity"), F.sum),
        "__first": (F.min("order_date"), F.min),
        "__last": (F.max("order_date"), F.max),
    }
    if key == "product_key":
        price = ratio("sales_amount", "quantity")
        found |= {"__prices": (F.sum(stable_units(price)), F.sum), "__priced": (F.count(price), F.sum)}
    return found


def sales_words(fact: DataFrame, key: str, order_codes: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dated sales per *fact* key as words of its orders, words of the other key, and sums, one row a key.

    Partial sums before any shuffle, no join. The words carry no sums: where order
    numbers lie apart there are about as many words as sales. Rows of several inputs may be put
    together (``union``) before :func:`_bitmap_aggregates` unites them.
    """
    dated = _dated(fact)
    sums = [a.alias(c) for c, (a, _) in _mergeable(key).items()]
    other = _COUNTED[key][0]
    orders = set_words(with_code(dated, "order_number", "__code", order_codes), [key], "__code")
    others = set_words(with_code(dated, other, "__code"), [key], "__code")
    return orders, others, dated.groupBy(key).agg(*sums)


def _bitmap_aggregates(words: tuple[DataFrame, DataFrame, DataFrame], dim: DataFrame, key: str) -> DataFrame:
    """:func:`_grain_aggregates` from bitmaps (:func:`sales_words`), without a fact-level join.

    Words and sums meet the dimension's keys, and sets and sums of all unknown keys unite
    under NULL. Nothing is expanded: each distinct column has an aggregate of its own,
    and one last aggregate per key puts them and the sums together.
    """
    other_alias = _COUNTED[key][1]
    merge = {c: how for c, (_, how) in _mergeable(key).items()}
    keys = dim.select(F.col(key).alias(_DIM_KEY))
    again = [how(c).alias(c) for c, how in merge.items()]

    def known(found: DataFrame) -> DataFrame:
        return found.join(keys, F.col(key) == F.col(_DIM_KEY), "left")

    def counted(found: DataFrame, out: str) -> DataFrame:
        count = F.coalesce(F.bit_count(BITS), F.lit(0)).cast("long")
        return coarser(known(found), [_DIM_KEY]).select(_DIM_KEY, count.alias(out))

    orders, others, sums = words
    parts = (counted(orders, "total_orders"), counted(others, other_alias), known(sums).select(_DIM_KEY, *merge))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    agg = rows.groupBy(_DIM_KEY).agg(F.sum("total_orders").alias("total_orders"), F.sum(other_alias).alias(other_alias), *again)
    last = F.col("__last")
    columns = [_DIM_KEY, "total_orders", F.col("total_sales"), F.col("total_qty"), other_alias]
    columns += [last.alias("last_sale_date" if key == "product_key" else "last_order_date")]
    columns += [month_boundaries("__first", "__last").alias("lifespan")]
    if key == "product_key":
        columns.append(units_mean("__prices", "__priced").alias("avg_selling_price"))
    return agg.select(*columns)


def product_report_of(words: tuple[DataFrame, DataFrame, DataFrame], products: DataFrame, as_of=None,
                      high: float = REFERENCE_HIGH_PERFORMER, mid: float = REFERENCE_MID_RANGE) -> DataFrame:
    """:func:`report_products` from :func:`sales_words`."""
    return _product_report(_bitmap_aggregates(words, products, "product_key"), products, as_of, high, mid)


def customer_report_of(words: tuple[DataFrame, DataFrame, DataFrame], customers: DataFrame, as_of=None,
                       min_months: int = REFERENCE_MIN_MONTHS, vip_spending: float = REFERENCE_VIP_SPENDING) -> DataFrame:
    """:func:`report_customers` from :func:`sales_words`."""
    agg = _bitmap_aggregates(words, customers, "customer_key")
    return _customer_report(agg, customers, as_of_date(as_of), min_months, vip_spending)


def report_products_from_bitmaps(
    fact: DataFrame,
    products: DataFrame,
    as_of=None,
    high: float = REFERENCE_HIGH_PERFORMER,
    mid: float = REFERENCE_MID_RANGE,
    order_codes: DataFrame | None = None,
) -> DataFrame:
    """:func:`report_products` with its two distinct counts from bitmaps.

    For facts whose two distinct columns are whole numbers, or with
    ``order_codes`` (:func:`starlens.operators.distinct_bitmaps.dense_codes` of the
    order numbers, made once per input) for text ones. Same rows.
    """
    return product_report_of(sales_words(fact, "product_key", order_codes), products, as_of, high, mid)


def report_customers_from_bitmaps(
    fact: DataFrame,
    customers: DataFrame,
    as_of=None,
    min_months: int = REFERENCE_MIN_MONTHS,
    vip_spending: float = REFERENCE_VIP_SPENDING,
    order_codes: DataFrame | None = None,
) -> DataFrame:
    """:func:`report_customers` with its two distinct counts from bitmaps; see :func:`report_products_from_bitmaps`."""
    return customer_report_of(sales_words(fact, "customer_key", order_codes), customers, as_of, min_months, vip_spending)


def report_products_by_known_keys(
    fact: DataFrame,
    products: DataFrame,
    as_of=None,
    high: float = REFERENCE_HIGH_PERFORMER,
    mid: float = REFERENCE_MID_RANGE,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """:func:`report_products` without its fact-level join: sales get their grain key from a membership filter.

    The fact is shuffled once, for the distinct counts. A dimension too large for the
    filter (see :mod:`starlens.operators.known_keys`) is joined as in :func:`report_products`.
    """
    base = grain_sales(_dated(fact), products, "product_key", _DIM_KEY, most_words)
    if base is None:
        return report_products(fact, products, as_of, high, mid)
    return _product_rows(base, products, as_of, high, mid, sales_repeated=False)


def report_customers_by_known_keys(
    fact: DataFrame,
    customers: DataFrame,
    as_of=None,
    min_months: int = REFERENCE_MIN_MONTHS,
    vip_spending: float = REFERENCE_VIP_SPENDING,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """:func:`report_customers` without its fact-level join; see :func:`report_products_by_known_keys`."""
    base = grain_sales(_dated(fact), customers, "customer_key", _DIM_KEY, most_words)
    if base is None:
        return report_customers(fact, customers, as_of, min_months, vip_spending)
    agg = _grain_aggregates(base, "customer_key")
    return _customer_report(agg, customers, as_of_date(as_of), min_months, vip_spending, sales_repeated=False)


def _near_aggregates(sales: DataFrame, key: str) -> DataFrame:
    """:func:`_grain_aggregates` of sales that lie together by their key, all of it known.

    An ``Expand`` would lose the layout, so each distinct count is an aggregate of its own.
    """
    other_key, other_alias = _COUNTED[key]
    dated = _dated(sales).withColumn(_DIM_KEY, F.col(key))
    orders = dated.groupBy(_DIM_KEY).agg(F.count_distinct("order_number").alias("total_orders"), *_plain_measures(key))
    return orders.join(dated.groupBy(_DIM_KEY).agg(F.count_distinct(other_key).alias(other_alias)), _DIM_KEY)


def _apart_aggregates(apart: DataFrame, grain: str, key: str) -> DataFrame:
    """:func:`_grain_aggregates` of sales that are spread whatever their key."""
    return _grain_aggregates(_dated(apart).withColumn(_DIM_KEY, F.col(grain)), key)


def report_products_copartitioned(
    sales: DataFrame,
    apart: DataFrame,
    grain: str,
    products: DataFrame,
    as_of=None,
    high: float = REFERENCE_HIGH_PERFORMER,
    mid: float = REFERENCE_MID_RANGE,
) -> DataFrame:
    """:func:`report_products` over a :class:`starlens.sources.copartitioned.CoPartitioned` layout.

    Products in buckets are aggregated and get their attributes without an exchange;
    only ``apart`` (hot and unknown products, by column ``grain``) is shuffled.
    """
    parts = (_near_aggregates(sales, "product_key"), _apart_aggregates(apart, grain, "product_key"))
    near, far = (_product_report(agg, products, as_of, high, mid, sales_repeated=False) for agg in parts)
    return near.unionByName(far)


def report_customers_copartitioned(
    sales: DataFrame,
    apart: DataFrame,
    grain: str,
    customers: DataFrame,
    as_of=None,
    min_months: int = REFERENCE_MIN_MONTHS,
    vip_spending: float = REFERENCE_VIP_SPENDING,
) -> DataFrame:
    """:func:`report_customers` over a co-partitioned layout; see :func:`report_products_copartitioned`."""
    today = as_of_date(as_of)
    parts = (_near_aggregates(sales, "customer_key"), _apart_aggregates(apart, grain, "customer_key"))
    near, far = (_customer_report(agg, customers, today, min_months, vip_spending, sales_repeated=False) for agg in parts)
    return near.unionByName(far)


def preview_report_products(
    fact: DataFrame,
    products: DataFrame,
    n: int = 10,
    as_of=None,
    high: float = REFERENCE_HIGH_PERFORMER,
    mid: float = REFERENCE_MID_RANGE,
) -> DataFrame:
    """The first ``n`` rows of the product report by product_key, the unknown products last.

    Equal to sorting the whole report so, but the fact is restricted to the
    ``n`` keys that can appear before it is joined or aggregated: only distinct
    keys and the shown keys' sales are shuffled.
    """
    base = _first_keys_sales(fact, products, "product_key", n)
    report = _product_rows(base, products, as_of, high, mid, sales_repeated=False)
    order = ["product_key", "product_name", "category", "subcategory", "cost"]
    return report.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def customers_in_age_range(report: DataFrame, low: int = 30, high: int = 39) -> DataFrame:
    """Report rows with ``low <= customer_age <= high``.

    For an existing (e.g. materialised) report. To compute the rows from the
    fact, ``report_customers(..., age_range=(low, high))`` gives the same
    rows while reading only the qualifying customers' sales.
    """
    return report.filter(F.col("customer_age").between(low, high))


def age_group_summary(report: DataFrame) -> DataFrame:
    """Customers (by non-null customer_number) and sales per age group."""
    return report.groupBy("age_groups").agg(
        F.count("customer_number").alias("total_customers"),
        F.sum("total_sales").alias("total_sales"),
    )


def age_group_totals(fact: DataFrame, customers: DataFrame, as_of=None) -> DataFrame:
    """:func:`age_group_summary` of the customer report, computed without the report.

    The summary needs only each customer's sum of sales, so the fact is summed
    per key first and only those per-key rows meet the dimension.
    """
    totals = _dated(fact).groupBy(F.col("customer_key").alias("__key")).agg(F.sum("sales_amount").alias("__sales"))
    attributes = _customer_attributes(customers, as_of_date(as_of))
    rows = totals.join(attributes, F.col("__key") == F.col(_DIM_KEY), "left")
    return rows.groupBy(age_group("customer_age").alias("age_groups")).agg(
        F.count("customer_number").alias("total_customers"),
        F.sum((F.col("__sales") * F.coalesce(F.col(_REPEATS), F.lit(1))).cast(totals.schema["__sales"].dataType)).alias("total_sales"),
    )


def register_reports(
    fact: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    as_of=None,
    prefix: str = "",
    **params,
) -> dict[str, DataFrame]:
    """Create or replace the views ``report_products`` and ``report_customers``.

    The reference's drop-and-recreate views: each read of a view re-runs its
    plan, so pass a fixed ``as_of`` to keep ages and recency stable. Extra
    keyword arguments go to the report whose signature names them.
    """
    prod_keys = {"high", "mid"}
    cust_keys = {"min_months", "vip_spending"}
    unknown = set(params) - prod_keys - cust_keys
    if unknown:
        raise TypeError(f"unknown report parameters {sorted(unknown)}")
    views = {
        "report_products": report_products(
            fact, products, as_of, **{k: v for k, v in params.items() if k in prod_keys}
        ),
        "report_customers": report_customers(
            fact, customers, as_of, **{k: v for k, v in params.items() if k in cust_keys}
        ),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return views
