"""Known keys by a membership filter and the co-partitioned layout: same rows as the reports, no exchange below the join."""

import datetime

import pytest
from pyspark.sql import functions as F

from starlens.operators import known_keys
from starlens.operators import reports as rep
from starlens.operators.known_keys import grain_sales, word_bound
from starlens.plans import catalog as cat
from starlens.plans.explain import plan_text, tree
from starlens.sources.copartitioned import GRAIN, open_copartitioned, write_copartitioned
from tests.conftest import SF_SMALL
from tests.test_distinct_bitmaps import awkward_star, rows_of

AS_OF = datetime.date(2023, 1, 1)


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_grain_keys_equal_a_left_join(spark, kind):
    known = [-(2**31), -65, -64, -1, 0, 63, 64, 700, 2**31 - 1, 64, None]
    tried = [*known, -2, 1, 62, 65, 699, 128]
    make = (lambda k: None if k is None else f"k{k}") if kind == "string" else (lambda k: k)
    fact = spark.createDataFrame([(make(k), i) for i, k in enumerate(tried * 3)], f"k {kind}, i int")
    dim = spark.createDataFrame([(make(k),) for k in known], f"k {'long' if kind == 'int' else kind}")
    got = grain_sales(fact, dim, "k", "g")
    if kind == "string":
        assert got is None
        return
    want = fact.join(dim.distinct().withColumnRenamed("k", "g"), F.col("k") == F.col("g"), "left")
    assert got.schema["g"].dataType == dim.schema["k"].dataType
    assert rows_of(got) == rows_of(want)
    assert rows_of(grain_sales(fact, dim.limit(0), "k", "g").select("g").distinct()) == [(None,)]


def test_only_a_checked_size_is_broadcast(spark):
    close = spark.range(1000).select(F.col("id").alias("k"))
    assert word_bound(close, "k") == 16
    ends = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (5,)], "k long")
    assert word_bound(ends, "k") == 3
    assert word_bound(close.limit(0), "k") == 0
    assert grain_sales(close, close, "k", "g", most_words=15) is None
    assert grain_sales(close, close, "k", "g", most_words=16) is not None


@pytest.mark.parametrize("most_words", [known_keys.MOST_WORDS, 0])
def test_reports_by_known_keys_equal_the_reports(spark, most_words):
    fact, products, customers = awkward_star(spark)
    got = rep.report_products_by_known_keys(fact, products, AS_OF, most_words=most_words)
    want = rep.report_products(fact, products, AS_OF)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert rows_of(got) == rows_of(want)
    got = rep.report_customers_by_known_keys(fact, customers, AS_OF, most_words=most_words)
    assert rows_of(got) == rows_of(rep.report_customers(fact, customers, AS_OF))


def test_known_keys_leave_one_fact_shuffle(spark, no_broadcast):
    fact, products, _ = awkward_star(spark)
    text = tree(plan_text(rep.report_products_by_known_keys(fact, products, AS_OF)))
    expand = text.index("Expand")
    assert "hashpartitioning" not in text[expand:] and "SortMergeJoin" not in text[expand:]


@pytest.mark.parametrize("rows_per_bucket", [40, 400, 10**6])
def test_reports_from_the_layout_equal_the_reports(spark, scratch, rows_per_bucket):
    fact, products, customers = awkward_star(spark)
    products_at, customers_at = f"{scratch}/p", f"{scratch}/c"
    write_copartitioned(fact, products, "product_key", products_at, rows_per_bucket)
    write_copartitioned(fact, customers, "customer_key", customers_at, rows_per_bucket, most_words=0)
    by = open_copartitioned(spark, products_at)
    assert by.buckets == -(-3000 // rows_per_bucket)
    assert by.sales.count() + by.apart.count() == 3000
    assert not set(by.sales.select("product_key").distinct().collect()) & set(by.apart.select(GRAIN).distinct().collect())
    got = rep.report_products_copartitioned(by.sales, by.apart, GRAIN, by.dimension, AS_OF)
    want = rep.report_products(fact, products, AS_OF)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert rows_of(got) == rows_of(want)
    names = by.joined("product_name").select("order_number", "sales_amount", "product_name")
    left = fact.join(products, "product_key", "left").select("order_number", "sales_amount", "product_name")
    assert rows_of(names) == rows_of(left)
    by = open_copartitioned(spark, customers_at)
    got = rep.report_customers_copartitioned(by.sales, by.apart, GRAIN, by.dimension, AS_OF)
    assert rows_of(got) == rows_of(rep.report_customers(fact, customers, AS_OF))


def test_hot_key_stays_spread_and_small_keys_stay_in_buckets(spark, scratch):
    keys = F.when(F.col("id") % 3 == 0, 7).otherwise(100 + F.col("id") % 500).cast("int")  # the fact's key is narrower
    fact = cat.star(spark, SF_SMALL).fact_sales.limit(1).crossJoin(spark.range(30_000)).withColumn("product_key", keys).drop("id")
    dim = spark.range(1000).select(F.col("id").alias("product_key"), F.concat(F.lit("p"), "id").alias("product_name"))
    write_copartitioned(fact, dim, "product_key", scratch, rows_per_bucket=2000)
    by = open_copartitioned(spark, scratch)
    assert [r[0] for r in by.apart.select(GRAIN).distinct().collect()] == [7]
    assert by.buckets == 15 and by.apart.count() == 10_000
    largest = by.sales.groupBy(F.pmod(F.hash("product_key"), F.lit(15))).count().orderBy(F.desc("count")).first()["count"]
    assert largest < 4000
    assert by.joined("product_name").where("product_name is null").count() == 0


def test_no_exchange_below_joins_and_aggregates_on_the_key(spark, scratch, no_broadcast):
    fact, products, _ = awkward_star(spark)
    write_copartitioned(fact, products, "product_key", scratch, 400)
    by = open_copartitioned(spark, scratch)
    attributes = by.dimension.select(F.col("product_key").alias("own"), "product_name")
    sales = by.sales.join(attributes, F.col("product_key") == F.col("own"))
    text = tree(plan_text(sales))
    assert "SortMergeJoin" in text and "Exchange" not in text
    near = rep._product_report(rep._near_aggregates(by.sales, "product_key"), by.dimension, AS_OF, 1, 1, sales_repeated=False)
    text = tree(plan_text(near))
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_another_catalog_opens_the_layout_by_its_folder(spark, scratch):
    fact, products, _ = awkward_star(spark)
    assert open_copartitioned(spark, scratch) is None
    folder = write_copartitioned(fact, products, "product_key", scratch, 4000)
    before = open_copartitioned(spark, scratch)
    rows = rows_of(before.sales)
    for name in ("sales", "dimension"):
        spark.sql(f"DROP TABLE starlens_{folder.rsplit('/', 1)[1]}_{name}")
    again = open_copartitioned(spark, scratch)
    assert rows_of(again.sales) == rows and rows_of(again.dimension) == rows_of(products)
    assert rows and "Bucketed: true" in plan_text(again.sales.groupBy("product_key").count())
    folder = write_copartitioned(fact, products, "product_key", scratch, 40)  # every key is hot
    spark.sql(f"DROP TABLE starlens_{folder.rsplit('/', 1)[1]}_sales")
    again = open_copartitioned(spark, scratch)
    assert again.sales.columns == fact.columns and again.sales.count() == 0 and again.apart.count() == 3000


def test_empty_tables(spark, scratch):
    fact, products, _ = awkward_star(spark)
    write_copartitioned(fact.limit(0), products, "product_key", f"{scratch}/a")
    write_copartitioned(fact, products.limit(0), "product_key", f"{scratch}/b")
    for at, f, p in (("a", fact.limit(0), products), ("b", fact, products.limit(0))):
        by = open_copartitioned(spark, f"{scratch}/{at}")
        got = rep.report_products_copartitioned(by.sales, by.apart, GRAIN, by.dimension, AS_OF)
        assert rows_of(got) == rows_of(rep.report_products(f, p, AS_OF))


@pytest.mark.parametrize("key", ["copartitioned_report_products", "copartitioned_report_customers", "known_report_products"])
def test_registered_queries_equal_the_reports(spark, key):
    statement = key.partition("_")[2]
    assert rows_of(cat.QUERIES[key](spark, SF_SMALL)) == rows_of(cat.QUERIES[statement](spark, SF_SMALL))
