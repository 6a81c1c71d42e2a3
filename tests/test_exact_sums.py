"""Correctly rounded sums of doubles, against whole-number arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from starlens.functions.exact_sums import exact_totals


def brute(values):
    """Sum and mean, rounded once."""
    total = sum(map(Fraction, values), Fraction(0))

    def nearest(x):
        try:
            return float(x)
        except OverflowError:
            return math.inf if x > 0 else -math.inf

    return nearest(total), nearest(total / len(values))


def mixed(rng, many):
    return [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-300, 300) for _ in range(many)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_equals_whole_number_arithmetic(spark, partitions):
    rng = random.Random(11)
    groups = {
        "mixed": mixed(rng, 900),
        "cancelling": (lambda v: v + [-x for x in v] + [1e-300])(mixed(rng, 300)),
        "near": [rng.uniform(900, 1000) for _ in range(500)],
        "subnormal": [5e-324, 1.5e-323, -5e-324, 2.2e-308],
        "largest": [1.7976931348623157e308] * 3,
        "ties": [1.0, 2.0**-53, 2.0**-106],
        "zeros": [0.0, -0.0],
        "powers": [2.0**k for k in range(-1074, 1024)] + [-(2.0**1023)],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(partitions)
    got = {r["k"]: (r["total"], r["mean"], r["n"]) for r in exact_totals(df, "k", "v", mean="mean", count="n").collect()}
    assert got == {k: (*brute(vs), len(vs)) for k, vs in groups.items()}


def test_nulls_and_unusual_values(spark):
    inf, nan = math.inf, math.nan
    groups = {"none": [None, None], "some": [None, 2.5], "inf": [inf, 1e300], "minus": [-inf, 3.0, -inf], "both": [inf, -inf], "nan": [nan, 1.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r["k"]: r["total"] for r in exact_totals(df, "k", "v").collect()}
    assert got["none"] is None and got["some"] == 2.5 and got["inf"] == inf and got["minus"] == -inf
    assert math.isnan(got["both"]) and math.isnan(got["nan"])


def test_without_keys_and_empty(spark):
    df = spark.createDataFrame([(1e300,), (1.0,), (-1e300,)], "v double")
    assert exact_totals(df, None, "v").collect()[0]["total"] == 1.0
    nothing = exact_totals(df.limit(0), None, "v", mean="m", count="n").collect()
    assert [tuple(r) for r in nothing] == [(None, None, 0)]
    assert exact_totals(df.limit(0).withColumn("k", F.lit(1)), "k", "v").collect() == []


def test_a_null_key_and_an_expression(spark):
    df = spark.createDataFrame([(None, 0.1, 1), (None, 0.2, 2), (3, 0.3, 3)], "k int, v double, w int")
    got = {r["k"]: r["total"] for r in exact_totals(df, ["k"], F.col("v") * F.col("w")).collect()}
    assert got == {None: brute([0.1, 0.4])[0], 3: 0.3 * 3}
