"""Live report views: catalog views whose body is the report as SQL over catalogued star tables.

The reference's views are re-evaluated on each read, by any session. Here
:func:`catalog_star` gives a gold layer's three tables catalog names, and
:func:`create_live_reports` defines the two reports over those names. The table
views read their folder by path, which lists its files on every read, so rows
appended to the folder are in any session's next read without publishing or
refreshing anything; a layer that :func:`starlens.sources.star.write_star` publishes
anew is picked up by calling :func:`catalog_star` again (one catalog operation).

``as_of`` is a date, or None for the current date at the time of each read, as
in the reference. Repeated dimension rows count as often as in the reference's
join of sales and dimension rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starlens.operators import reports as rep
from starlens.operators.segmentation import REFERENCE_MIN_MONTHS, REFERENCE_VIP_SPENDING
from starlens.sources import schemas
from starlens.sources.publish import build_folder, published
from starlens.sources.star import YEAR_FOLDER

TABLES = tuple(schemas.STAR)


def _name(database: str | None, name: str) -> str:
    return ".".join(f"`{part}`" for part in ((database, name) if database else (name,)))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def catalog_star(spark: SparkSession, root: str, database: str | None = None, prefix: str = "") -> None:
    """Create or replace the views ``fact_sales``, ``dim_products`` and ``dim_customers`` over the gold layer at ``root``.

    The current build where one is published, else ``{root}/{table}``. A view lists the
    table's columns by name, without the folder column of the year layout.
    """
    root = root.rstrip("/")
    pointer = published(spark, root)
    folder = build_folder(root, pointer) if pointer is not None else root
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for table in TABLES:
        path = f"{folder}/{table}"
        columns = [f"`{c}`" for c in spark.read.parquet(path).columns if c != YEAR_FOLDER]
        spark.sql(f"CREATE OR REPLACE VIEW {_name(database, prefix + table)} AS SELECT {', '.join(columns)} FROM parquet.`{path}`")


def _months(a: str, b: str) -> str:
    return f"((year({b}) - year({a})) * 12 + month({b}) - month({a}))"


def _today(as_of) -> str:
    return "current_date()" if as_of is None else f"DATE '{as_of}'"


def _cases(branches: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {_literal(label)}" for test, label in branches) + f" ELSE {_literal(default)} END"


def _measures_sql(fact: str, dim: str, key: str, other: str, sums: dict[str, str]) -> str:
    """CTE ``measures``: per key of the dimension (NULL: unknown keys) ``sums``, ``orders`` and ``others``, once per dimension row of the key.

    As in :func:`starlens.operators.reports._slim_aggregates` the sums and either distinct count
    have an aggregate of their own, by the key alone.
    """
    names = [*sums, "orders", "others"]

    def part(found: dict[str, str]) -> str:
        return f"SELECT grain, {', '.join(f'{found.get(n, "NULL")} AS {n}' for n in names)} FROM sales GROUP BY grain"

    parts = (sums, {"orders": "count(DISTINCT order_number)"}, {"others": f"count(DISTINCT {other})"})
    return f"""
sales AS (
  SELECT d.{key} AS grain, f.order_number, f.{other}, f.order_date, f.sales_amount, f.quantity
  FROM {fact} f LEFT JOIN (SELECT {key} FROM {dim}) d ON f.{key} = d.{key}
  WHERE f.order_date IS NOT NULL
),
measures AS (
  SELECT grain, {', '.join(f'max({n}) AS {n}' for n in names)}
  FROM ({' UNION ALL '.join(part(p) for p in parts)}) GROUP BY grain
)"""


#: Sums of a key's sales that :func:`_measures_sql` saw once per dimension row of the key, for the rows of one attribute tuple.
_SCALED = """CASE WHEN repeats IS NULL OR repeats = key_rows THEN {0} ELSE {0} * repeats div key_rows END"""
_REPEATS = "count(*) AS repeats, sum(count(*)) OVER (PARTITION BY {0}) AS key_rows"
_SUMS = {
    "sales": "sum(sales_amount)",
    "qty": "sum(quantity)",
    "first_date": "min(order_date)",
    "last_date": "max(order_date)",
}
_PRICE = "CAST(sales_amount AS DOUBLE) / nullif(quantity, 0)"


def product_report_sql(fact: str, products: str, as_of=None, high: float = rep.REFERENCE_HIGH_PERFORMER, mid: float = rep.REFERENCE_MID_RANGE) -> str:
    """The product report as one SELECT over the named tables (whole-number amounts)."""
    segment = _cases([(f"total_sales > {high}", rep.HIGH_PERFORMERS), (f"total_sales >= {mid}", rep.MID_RANGE)], rep.LOW_PERFORMERS)
    prices = {"price_units": f"sum(CAST(round({_PRICE} * 1.0E12D, 0) AS DECIMAL(38, 0)))", "prices": f"count({_PRICE})"}
    return f"""
WITH {_measures_sql(fact, products, "product_key", "customer_key", _SUMS | prices)},
attributes AS (
  SELECT product_key, product_name, category, subcategory, cost, {_REPEATS.format("product_key")}
  FROM {products} WHERE product_key IS NOT NULL
  GROUP BY product_key, product_name, category, subcategory, cost
),
lives AS (
  SELECT product_key, product_name, category, subcategory, cost, orders AS total_orders, {_SCALED.format("sales")} AS total_sales,
         others AS total_customers, {_SCALED.format("qty")} AS total_qty, last_date AS last_sale_date,
         {_months('first_date', 'last_date')} AS lifespan, CAST(price_units AS DOUBLE) / nullif(prices, 0) / 1.0E12D AS avg_selling_price
  FROM measures LEFT JOIN attributes ON grain = product_key
)
SELECT product_key, product_name, category, subcategory, cost, {segment} AS product_segment,
       total_orders, total_sales, total_customers, total_qty, last_sale_date, lifespan, avg_selling_price,
       {_months('last_sale_date', _today(as_of))} AS recency_in_months,
       CASE WHEN total_sales = 0 THEN 0 ELSE total_sales div nullif(total_orders, 0) END AS AOR,
       CASE WHEN lifespan = 0 THEN 0 ELSE total_sales div nullif(lifespan, 0) END AS AMR
FROM lives"""


def customer_report_sql(
    fact: str, customers: str, as_of=None, min_months: int = REFERENCE_MIN_MONTHS, vip_spending: float = REFERENCE_VIP_SPENDING
) -> str:
    """The customer report as one SELECT over the named tables (whole-number amounts)."""
    ages = [(f"customer_age <= {hi}" if lo is None else f"customer_age BETWEEN {lo} AND {hi}", label) for label, lo, hi in rep.AGE_GROUPS]
    loyal = f"lifespan >= {min_months}"
    segment = _cases([(f"{loyal} AND total_sales > {vip_spending}", "VIP"), (f"{loyal} AND total_sales <= {vip_spending}", "Regular")], "New")
    return f"""
WITH {_measures_sql(fact, customers, "customer_key", "product_key", _SUMS)},
named AS (
  SELECT customer_key, customer_number, concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS customer_name,
         year({_today(as_of)}) - year(birthdate) AS customer_age
  FROM {customers} WHERE customer_key IS NOT NULL
),
attributes AS (
  SELECT customer_key, customer_number, customer_name, customer_age, {_REPEATS.format("customer_key")}
  FROM named GROUP BY customer_key, customer_number, customer_name, customer_age
),
lives AS (
  SELECT customer_key, customer_number, coalesce(customer_name, ' ') AS customer_name, customer_age, orders AS total_orders,
         {_SCALED.format("sales")} AS total_sales, {_SCALED.format("qty")} AS total_qty, others AS total_products,
         last_date AS last_order_date, {_months('first_date', 'last_date')} AS lifespan
  FROM measures LEFT JOIN attributes ON grain = customer_key
)
SELECT customer_key, customer_number, customer_name, customer_age, {_cases(ages, rep.AGE_GROUP_DEFAULT)} AS age_groups,
       {segment} AS customer_segment, total_orders, total_sales, total_qty, total_products, last_order_date, lifespan,
       {_months('last_order_date', _today(as_of))} AS recency,
       CASE WHEN total_sales = 0 THEN 0 ELSE total_sales div nullif(total_orders, 0) END AS AVO,
       CASE WHEN lifespan = 0 THEN total_sales ELSE total_sales div nullif(lifespan, 0) END AS AMS
FROM lives"""


def create_live_reports(spark: SparkSession, as_of=None, database: str | None = None, prefix: str = "", **params) -> list[str]:
    """Create or replace the catalog views ``report_products`` and ``report_customers`` over :func:`catalog_star`'s names.

    Keyword arguments are the bounds of the two reports (high, mid, min_months, vip_spending). Returns the views' names.
    """
    product = {k: params.pop(k) for k in ("high", "mid") if k in params}
    customer = {k: params.pop(k) for k in ("min_months", "vip_spending") if k in params}
    if params:
        raise TypeError(f"unknown report parameters {sorted(params)}")
    fact, products, customers = (_name(database, prefix + t) for t in ("fact_sales", "dim_products", "dim_customers"))
    bodies = {
        "report_products": product_report_sql(fact, products, as_of, **product),
        "report_customers": customer_report_sql(fact, customers, as_of, **customer),
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE VIEW {_name(database, prefix + name)} AS {body}")
    return [_name(database, prefix + name) for name in bodies]


def drop_live_reports(spark: SparkSession, database: str | None = None, prefix: str = "") -> None:
    """Drop the report and table views if they exist; data are not touched."""
    for name in ("report_products", "report_customers", *TABLES):
        spark.sql(f"DROP VIEW IF EXISTS {_name(database, prefix + name)}")


def read_view(spark: SparkSession, name: str) -> DataFrame:
    """A catalog view by its (quoted) name, evaluated anew."""
    return spark.sql(f"SELECT * FROM {name}")
