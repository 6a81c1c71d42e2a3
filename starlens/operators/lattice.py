"""Summary lattice: a few stored summaries of the fact, and a router that answers coarser statements from them.

The levels are aggregates whose measures merge (sums, counts, sets as words of
bits), so any coarser bucket follows from a finer one exactly:

| level | keys | measures |
| --- | --- | --- |
| ``month_product`` | order month, product key | sums |
| ``month_customers`` | order month, word of customers | sums, customers as bits |
| ``month`` | order month | sums (rolled up from ``month_product``) |
| ``ship_month`` | shipping month | sums |

``Lattice.rows(keys, measures)`` picks the stored level with the fewest rows that has
what is asked. A lattice is published under the version of the inputs it was
built from; :func:`open_lattice` only opens one whose version is the current one,
and a statement without a stored level is computed from the fact by the same
expressions, so nothing is ever answered from an older input. A build is
published whole, after its last level is written.

Sizes: ``month_product`` has at most months x products rows, ``month_customers`` at most
months x customers / 64 where customer keys lie close together, both never
more than the fact; the other two have a row per month.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.functions.columns import as_cols
from starlens.functions.dates import bucket, month_label, month_start, year_start
from starlens.functions.numeric import int_div, is_integral
from starlens.operators.change_over_time import Key
from starlens.operators.cumulative import expanding_avg, running_total
from starlens.operators.distinct_bitmaps import BITS, coarser, set_words, size_of, with_code
from starlens.sources.publish import build_folder, publish, published
from starlens.sources.star import Star

MONTH, SHIP_MONTH, PRODUCT = "order_month", "shipping_month", "product_key"
CUSTOMERS = "customers"
#: Measures that every level has, as (source column, aggregate); all merge by sum.
SUMS = {
    "total_sales": ("sales_amount", F.sum),
    "total_qty": ("quantity", F.sum),
    "price_sum": ("price", F.sum),
    "price_count": ("price", F.count),
}


@dataclass(frozen=True)
class Level:
    keys: tuple[str, ...]
    customers: bool = False
    #: A finer level this one is rolled up from when the lattice is built.
    rolled_from: str | None = None

    def has(self, keys: Collection[str], measures: Collection[str]) -> bool:
        return set(keys) <= set(self.keys) and set(measures) <= {*SUMS, *([CUSTOMERS] if self.customers else [])}


LEVELS = {
    "month_product": Level((MONTH, PRODUCT)),
    "month_customers": Level((MONTH,), customers=True),
    "month": Level((MONTH,), rolled_from="month_product"),
    "ship_month": Level((SHIP_MONTH,)),
}

_KEYS = {
    MONTH: lambda: month_start("order_date"),
    SHIP_MONTH: lambda: month_start("shipping_date"),
    PRODUCT: lambda: F.col("product_key"),
}


def merged_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in SUMS]


def summarised(fact: DataFrame, level: Level) -> DataFrame:
    """A level's rows from the fact: one partial and one final aggregate."""
    keys = [_KEYS[k]().alias(k) for k in level.keys]
    sums = [how(source).alias(c) for c, (source, how) in SUMS.items()]
    if level.customers:
        return set_words(with_code(fact, "customer_key", "__code"), keys, "__code", *sums)
    return fact.groupBy(*keys).agg(*sums)


@dataclass(frozen=True)
class Lattice:
    """Stored levels with their numbers of rows; levels that aren't stored are computed from the star's fact."""

    star: Star
    stored: dict[str, DataFrame] = field(default_factory=dict)
    many: dict[str, int] = field(default_factory=dict)

    def route(self, keys: Collection[str], measures: Collection[str]) -> str | None:
        """The stored level with the fewest rows that has all keys and measures; None if there is none."""
        able = [name for name in self.stored if LEVELS[name].has(keys, measures)]
        return min(able, key=lambda name: (self.many[name], name), default=None)

    def rows(self, keys: Collection[str], measures: Collection[str]) -> DataFrame:
        name = self.route(keys, measures)
        if name is not None:
            return self.stored[name]
        level = next(lv for lv in LEVELS.values() if lv.has(keys, measures))
        return summarised(self.star.fact_sales, level)

    # --- statements -----------------------------------------------------------

    def trend(self, by: list[Key], measures: Collection[str] = ("total_sales", CUSTOMERS, "total_qty")) -> DataFrame:
        """:func:`starlens.operators.change_over_time.trend` of dated sales; ``customers`` gives total_customers."""
        rows = self.rows([MONTH], measures).where(F.col(MONTH).isNotNull())
        labels = {alias: f"__{alias}_month" for alias, grain in by if grain == "month_label"}
        keys = [bucket(F.col(MONTH), "month" if a in labels else g).alias(labels.get(a, a)) for a, g in by]
        names = [labels.get(a, a) for a, _ in by]
        sums = [F.sum(m).alias(m) for m in measures if m != CUSTOMERS]
        if CUSTOMERS in measures:
            rows = coarser(rows.select(*keys, "__word", BITS, *(m for m in measures if m != CUSTOMERS)), names, *sums)
            out = rows.groupBy(*names).agg(size_of(BITS).alias("total_customers"), *sums)
        else:
            out = rows.groupBy(*keys).agg(*sums)
        finals = [month_label(F.col(labels[a])).alias(a) if a in labels else F.col(a) for a, _ in by]
        return out.select(*finals, *("total_customers" if m == CUSTOMERS else m for m in measures)).orderBy(*(a for a, _ in by))

    def monthly(self, alias: str = MONTH) -> DataFrame:
        rows = self.rows([MONTH], ["total_sales"]).where(F.col(MONTH).isNotNull())
        return rows.groupBy(F.col(MONTH).alias(alias)).agg(F.sum("total_sales").alias("total_sales"))

    def running_sales(self, alias: str = MONTH, reset_by: Callable | None = None, partition_by_period: bool = False) -> DataFrame:
        """:func:`starlens.operators.cumulative.running_sales`."""
        parts = as_cols(alias) if partition_by_period else [reset_by(F.col(alias))] if reset_by else None
        return running_total(self.monthly(alias), alias, "total_sales", partition_by=parts)

    def running_quantity_shipped(self) -> DataFrame:
        """:func:`starlens.operators.cumulative.running_quantity_shipped`, undated shipments included."""
        rows = self.rows([SHIP_MONTH], ["total_qty"])
        series = rows.groupBy(SHIP_MONTH).agg(F.sum("total_qty").alias("monthly_qty_shipped"))
        out = running_total(series, SHIP_MONTH, "monthly_qty_shipped", out="running_qty")
        return out.orderBy(F.col(SHIP_MONTH).asc_nulls_first())

    def yearly_running_with_avg_price(self, mode: str = "truncate") -> DataFrame:
        """:func:`starlens.operators.cumulative.yearly_running_with_avg_price`; the mean is of sums and counts."""
        rows = self.rows([MONTH], ["total_sales", "price_sum", "price_count"]).where(F.col(MONTH).isNotNull())
        whole = mode == "truncate" and is_integral(self.star.fact_sales, "price")
        total, count = F.sum("price_sum"), F.sum("price_count")
        mean = int_div(total, count) if whole else total.cast("double") / F.nullif(count, F.lit(0))
        yearly = rows.groupBy(year_start(MONTH).alias("order_date")).agg(F.sum("total_sales").alias("total_sales"), mean.alias("avg_price"))
        out = running_total(yearly, "order_date", "total_sales")
        out = expanding_avg(out, "order_date", "avg_price", "moving_avg_price", mode=mode)
        return out.select("order_date", "total_sales", "running_total", "moving_avg_price")

    def product_sales(self, period: str = "order_year", grain: str = "year", entity: str = "product_name") -> DataFrame:
        """:func:`starlens.operators.performance.period_sales`: summary rows, not sales, meet the dimension."""
        rows = self.rows([MONTH, PRODUCT], ["total_sales"]).where(F.col(MONTH).isNotNull())
        periods = rows.groupBy(bucket(F.col(MONTH), grain).alias(period), PRODUCT).agg(F.sum("total_sales").alias("__sales"))
        products = self.star.dim_products.select(F.col("product_key").alias("__known"), entity)
        joined = periods.join(products, F.col(PRODUCT) == F.col("__known"), "left")
        return joined.groupBy(period, entity).agg(F.sum("__sales").alias("current_sales"))


def build_lattice(star: Star, root: str, version: str) -> str:
    """Write every level and publish them at ``root`` as the lattice of input ``version``; returns the build's folder."""
    spark = star.fact_sales.sparkSession

    def write(folder: str) -> None:
        for name, level in LEVELS.items():
            if level.rolled_from:
                finer = spark.read.parquet(f"{folder}/{level.rolled_from}")
                rows = finer.groupBy(*level.keys).agg(*merged_sums())
            else:
                rows = summarised(star.fact_sales, level)
            rows.write.parquet(f"{folder}/{name}")

    return publish(spark, root, write, version)


def open_lattice(spark: SparkSession, star: Star, root: str, version: str) -> Lattice | None:
    """The lattice published at ``root`` if it is of input ``version``, else None."""
    pointer = published(spark, root)
    if pointer is None or pointer["layout"] != version:
        return None
    folder = build_folder(root, pointer)
    stored = {name: spark.read.parquet(f"{folder}/{name}") for name in LEVELS}
    # a count of Parquet rows reads file footers only
    return Lattice(star, stored, {name: df.count() for name, df in stored.items()})


def fresh_lattice(spark: SparkSession, star: Star, root: str, version: str) -> Lattice:
    """The lattice of input ``version``, built first where an older one or none is published."""
    found = open_lattice(spark, star, root, version)
    if found is None:
        build_lattice(star, root, version)
        found = open_lattice(spark, star, root, version)
    return found
