"""Running sums of rows of any grain: equal to the window, spread over tasks."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starlens.operators.cumulative import running_window
from starlens.operators.prefix_scan import prefix_sums, running_rows
from starlens.plans import catalog as cat
from starlens.plans.explain import plan_text
from tests.conftest import SF_SMALL


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def lines(spark, many=4000):
    """A third of the rows on one day, NULL days, NULL measures, repeated rows."""
    rng = random.Random(3)
    day = datetime.date(2021, 1, 1)
    rows = []
    for i in range(many):
        at = day if rng.random() < 0.34 else None if rng.random() < 0.05 else day + datetime.timedelta(days=rng.randint(-400, 400))
        rows.append((at, rng.choice(["a", "b", None]), None if rng.random() < 0.1 else rng.randint(-9, 99), Decimal(rng.randint(0, 999)) / 100))
    return spark.createDataFrame(rows + rows[:50], "at date, part string, x long, d decimal(9,2)").repartition(5)


@pytest.mark.parametrize("blocks", [1, 3, 16])
@pytest.mark.parametrize("parts", [None, ["part"], ["year", "part"]])
def test_equals_the_window(spark, blocks, parts):
    df = lines(spark).withColumn("year", F.year("at")).cache()
    w = running_window("at", parts)
    want = df.withColumns({"t": F.sum("x").over(w), "e": F.sum("d").over(w), "n": F.count("x").over(w)})
    got = prefix_sums(df, "at", ["x", "d"], parts, blocks).select(*df.columns, F.col("x__sum").alias("t"), F.col("d__sum").alias("e"), F.col("x__count").alias("n"))
    assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert rows_of(got) == rows_of(want)


def test_frames_without_values_and_empty_input(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5), (4, None)], "k int, x int")
    got = running_rows(df, "k", {"t": "x"}, {"m": "x"}, blocks=4).orderBy("k").collect()
    assert [(r["t"], r["m"]) for r in got] == [(None, None), (None, None), (5, 5), (5, 5)]
    empty = running_rows(df.limit(0), "k", {"t": "x"})
    assert empty.columns == ["k", "x", "t"] and empty.count() == 0
    assert running_rows(df, "k").columns == df.columns


def test_means_by_mode(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 9)], "k int, x int")
    modes = {m: [r["m"] for r in running_rows(df, "k", averages={"m": "x"}, mode=m).orderBy("k").collect()] for m in ("truncate", "exact")}
    assert modes == {"truncate": [1, 1, 4], "exact": [1.0, 1.5, 4.0]}
    with pytest.raises(ValueError):
        running_rows(df, "k", averages={"m": "x"}, mode="other")


def test_clashing_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="x__sum"):
        prefix_sums(spark.createDataFrame([(1, 2, 3)], "k int, x int, x__sum int"), "k", ["x"])


@pytest.mark.parametrize("key", ["running_line_sales", "running_line_sales_reset_yearly", "running_line_qty_by_ship_date"])
def test_registered_scans_sort_no_rows_in_one_task(spark, key):
    df = cat.QUERIES[key](spark, SF_SMALL)
    plan = plan_text(df)
    # the one row per block is all that may meet in one partition
    single = [at for at in plan.split("\n") if "SinglePartition" in at]
    assert len(single) <= 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert df.count() > 1000


def test_line_totals_equal_a_window_over_the_lines(spark):
    s = cat.star(spark, SF_SMALL)
    w = Window.orderBy("order_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    want = s.dated_sales().select("order_number", "product_key", "order_date", "sales_amount", F.sum("sales_amount").over(w).alias("running_total"))
    assert rows_of(cat.running_line_sales(s).select(*want.columns)) == rows_of(want)
