"""Distinct counts from bitmaps: exact, merging, for any key type, and the reports built from them."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from starlens.operators import reports as rep
from starlens.operators.distinct_bitmaps import coarser, dense_codes, set_words, sizes, with_code
from starlens.plans import catalog as cat
from starlens.plans.explain import plan_text
from tests.conftest import SF_SMALL


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dense_codes_number_without_gaps(spark):
    df = spark.createDataFrame([(f"SO-{i % 700}" if i % 11 else None,) for i in range(3000)], "k string").repartition(7)
    codes = dense_codes(df, "k").collect()
    assert sorted(r["code"] for r in codes) == list(range(len(codes)))
    assert {r["value"] for r in codes} == {r["k"] for r in df.collect()} - {None}
    assert dense_codes(df.limit(0), "k").count() == 0


@pytest.mark.parametrize("kind", ["long", "int", "string", "date"])
def test_months_unite_into_years(spark, kind):
    rng = random.Random(5)
    make = {
        "long": lambda k: (k - 300) * 10**12,  # negative and far apart
        "int": lambda k: k - 300,
        "string": lambda k: f"customer {k}",
        "date": lambda k: datetime.date(2000, 1, 1) + datetime.timedelta(days=k),
    }[kind]
    rows = [(rng.randint(1, 24) if rng.random() < 0.9 else None, None if rng.random() < 0.05 else make(rng.randint(0, 600))) for _ in range(5000)]
    df = with_code(spark.createDataFrame(rows, f"month int, k {kind}"), "k", "code")
    months = set_words(df, ["month"], "code", F.count("*").alias("sales"))
    years = coarser(months.withColumn("year", F.floor((F.col("month") - 1) / 12)), ["year"], F.sum("sales").alias("sales"))
    got = sizes(years, ["year"], "n", F.sum("sales").alias("sales"))
    year = F.floor((F.col("month") - 1) / 12).alias("year")
    want = df.groupBy(year).agg(F.count_distinct("k").alias("n"), F.count("*").alias("sales"))
    assert rows_of(got) == rows_of(want)
    assert rows_of(sizes(months, ["month"], "n")) == rows_of(df.groupBy("month").agg(F.count_distinct("k")))


def test_words_are_few_where_keys_lie_close(spark):
    df = spark.range(100_000).select(F.lit(1).alias("g"), F.col("id").alias("code"))
    assert set_words(df, ["g"], "code").count() == -(-100_000 // 64)


def awkward_star(spark):
    """Text order numbers, repeated, unknown and NULL dimension keys, undated and zero-quantity sales, a hot product."""
    rng = random.Random(9)
    day = datetime.date(2020, 1, 1)
    sales = [
        (
            f"SO{rng.randint(1, 400)}" if rng.random() < 0.97 else None,
            1 if rng.random() < 0.34 else rng.choice([2, 3, 4, 98, 99, None]),
            rng.choice([1, 2, 3, 77, 78, None]),
            day + datetime.timedelta(days=rng.randint(0, 900)) if rng.random() < 0.95 else None,
            rng.choice([0, 5, 1999, 30_000]),
            rng.choice([0, 1, 2, 7]),
        )
        for _ in range(3000)
    ]
    fact = spark.createDataFrame(
        sales, "order_number string, product_key long, customer_key long, order_date date, sales_amount long, quantity int"
    )
    products = spark.createDataFrame(
        [(1, "a", "x", "s", 1.0), (2, "b", "x", "s", None), (2, "b", "x", "s", None), (3, "c", None, "s", 7.0), (4, "a", "y", "t", 9.0), (4, "z", "y", "t", 9.0), (None, "n", "n", "n", 0.0)],
        "product_key long, product_name string, category string, subcategory string, cost double",
    )
    customers = spark.createDataFrame(
        [(1, "C1", None, "L", day), (2, "C2", "F", None, None), (3, "C3", "F", "L", day), (3, "C3", "F", "L", day)],
        "customer_key long, customer_number string, first_name string, last_name string, birthdate date",
    )
    return fact, products, customers


def test_reports_from_bitmaps_equal_the_reports(spark):
    fact, products, customers = awkward_star(spark)
    as_of = datetime.date(2023, 1, 1)
    codes = dense_codes(fact, "order_number")
    for given in (None, codes):
        got = rep.report_products_from_bitmaps(fact, products, as_of, order_codes=given)
        want = rep.report_products(fact, products, as_of)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert rows_of(got) == rows_of(want)
        got = rep.report_customers_from_bitmaps(fact, customers, as_of, order_codes=given)
        assert rows_of(got) == rows_of(rep.report_customers(fact, customers, as_of))
    empty = rep.report_products_from_bitmaps(fact.limit(0), products, as_of)
    assert empty.count() == 0


@pytest.mark.parametrize("key", ["bitmap_report_products", "bitmap_report_customers"])
def test_no_expand(spark, key):
    assert "Expand" not in plan_text(cat.QUERIES[key](spark, SF_SMALL))
