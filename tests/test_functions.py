
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from starlens.functions import (
    as_of_date,
    avg_of,
    band_labels,
    bucket,
    full_name,
    int_div,
    month_boundaries,
    pct_label,
    range_band,
    sign_label,
    year_boundaries,
)


def one(spark, expr, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def test_month_boundaries_counts_calendar_crossings(spark):
    # M2 / T1: 2011-01-31 -> 2011-02-01 crosses one month boundary.
    df = spark.createDataFrame(
        [(dt.date(2011, 1, 31), dt.date(2011, 2, 1)), (dt.date(2011, 1, 1), dt.date(2011, 1, 31)),
         (dt.date(2010, 12, 15), dt.date(2012, 1, 1)), (dt.date(2012, 5, 1), dt.date(2011, 6, 1))],
        "a date, b date",
    )
    got = [r["m"] for r in df.select(month_boundaries("a", "b").alias("m")).collect()]
    assert got == [1, 0, 13, -11]


def test_year_boundaries_is_age_as_counted_by_reference(spark):
    # M3 / T1: born 1980-12-31, as of 2025-12-01 -> 45 (not 44).
    v = one(spark, year_boundaries(F.col("b"), as_of_date("2025-12-01")), "b date", (dt.date(1980, 12, 31),))
    assert v == 45


def test_int_div_truncates_and_guards_zero(spark):
    # M4 / T2: 7 / 2 = 3; T3: zero divisor gives NULL instead of an error.
    df = spark.createDataFrame([(7, 2), (-7, 2), (10, 0), (5, None)], "a long, b long")
    got = [r["q"] for r in df.select(int_div("a", "b").alias("q")).collect()]
    assert got == [3, -3, None, None]


def test_avg_of_truncates_integral_mean(spark):
    df = spark.createDataFrame([(3,), (4,), (None,)], "x long")
    row = df.agg(avg_of("x").alias("t"), avg_of("x", "exact").alias("e")).first()
    assert row["t"] == 3 and row["e"] == 3.5


def test_full_name_reads_null_as_empty(spark):
    # M6 / T5
    df = spark.createDataFrame([(None, "Smith"), ("Ann", None), ("Ann", "Lee")], "f string, l string")
    got = [r["n"] for r in df.select(full_name("f", "l").alias("n")).collect()]
    assert got == [" Smith", "Ann ", "Ann Lee"]


def test_pct_label_short_form(spark):
    # M7 / T6: 96.0 -> '96%', 100 -> '100%', 0.0001 -> '0.0001%', 0 -> '0%'.
    df = spark.createDataFrame([(96.0,), (100.0,), (0.0001,), (0.0,), (12.34565,), (None,)], "s double")
    got = [r["p"] for r in df.select(pct_label("s", 4).alias("p")).collect()]
    assert got == ["96%", "100%", "0.0001%", "0%", "12.3457%", "%"]
    got2 = [r["p"] for r in df.select(pct_label("s", 2).alias("p")).collect()]
    assert got2 == ["96%", "100%", "0%", "0%", "12.35%", "%"]


def test_range_band_first_match_and_null(spark):
    # M8 / T7: edges overlap at 500 and 1000; the first match wins; NULL -> top band.
    costs = [None, 99.0, 100.0, 500.0, 501.0, 1000.0, 1001.0]
    df = spark.createDataFrame([(c,) for c in costs], StructType([StructField("cost", DoubleType())]))
    got = [r["b"] for r in df.select(range_band("cost", (100, 500, 1000)).alias("b")).collect()]
    assert got == ["Above 1000", "Below 100", "100-500", "100-500", "500-1000", "500-1000", "Above 1000"]
    assert band_labels((100, 500, 1000)) == ["Below 100", "100-500", "500-1000", "Above 1000"]


def test_sign_label_null_is_no_change(spark):
    df = spark.createDataFrame([(1,), (-1,), (0,), (None,)], StructType([StructField("d", LongType())]))
    got = [r["l"] for r in df.select(sign_label("d", "Increase", "Decrease", "No change").alias("l")).collect()]
    assert got == ["Increase", "Decrease", "No change", "No change"]


@pytest.mark.parametrize(
    "grain,expected",
    [
        ("year", 2013),
        ("month_number", 3),
        ("month", dt.date(2013, 3, 1)),
        ("year_start", dt.date(2013, 1, 1)),
        ("month_label", "2013-Mar"),
    ],
)
def test_buckets(spark, grain, expected):
    v = one(spark, bucket(F.col("d"), grain), "d date", (dt.date(2013, 3, 17),))
    assert v == expected


def test_bucket_rejects_unknown_grain():
    with pytest.raises(ValueError):
        bucket(F.col("d"), "week")


def test_no_python_udfs_in_expressions(spark):
    df = spark.createDataFrame([("a", 1.0)], StructType([StructField("s", StringType()), StructField("x", DoubleType())]))
    from starlens.plans.explain import PYTHON_NODES, plan_text

    plan = plan_text(df.select(pct_label("x", 2), full_name("s", "s")))
    assert not any(node in plan for node in PYTHON_NODES)
