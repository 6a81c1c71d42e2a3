"""Scale-motivated rewrites give the same answers as the naive plans.

- pre-aggregation before a dimension join equals join-then-aggregate, for
  any dimension (duplicate keys, missing keys, NULL keys);
- a left join whose skewed partitions AQE splits (one hot key, and all the
  NULL keys of unmatched rows, land in one partition) returns the same rows.
"""

import random

import pytest
from pyspark.sql import functions as F

from starlens.operators.preaggregate import dim_totals
from starlens.plans import catalog as cat
from starlens.plans.explain import plan_text
from tests.conftest import SF_CHECK


def naive(fact, dim, fact_cols=()):
    j = fact.alias("f").join(dim.alias("d"), F.col("f.k") == F.col("d.k"), "left")
    keys = [e.alias(n) for n, e in fact_cols] + [F.col("d.attr").alias("attr")]
    return j.groupBy(*keys).agg(
        F.sum("f.x").alias("s"), F.min("f.t").alias("lo"), F.max("f.t").alias("hi"), F.count("f.x").alias("n")
    )


def fast(fact, dim, fact_cols=()):
    return dim_totals(
        fact, dim, "k", "k", [("attr", "attr")],
        [("s", "sum", "x"), ("lo", "min", "t"), ("hi", "max", "t"), ("n", "count", "x")],
        fact_cols=fact_cols,
    )


def rows(df):
    """Collect ``df`` itself (so its plan is final) as a sorted, column-order-free list."""
    cols = sorted(df.columns)
    return sorted(str(tuple(r[c] for c in cols)) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_preaggregation_is_exact_for_any_dimension(spark, seed):
    rnd = random.Random(seed)
    fact = spark.createDataFrame(
        [
            (rnd.choice([None, 1, 2, 3, 4, 5, 99]), rnd.choice([None, rnd.randint(-50, 50)]), rnd.randint(0, 9), rnd.randint(1, 3))
            for _ in range(400)
        ],
        "k long, x long, t int, g int",
    )
    # duplicate key 2 (two attribute values), key 3 twice with the same attribute,
    # keys 5 and 99 missing, a NULL dimension key
    dim = spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "c"), (3, "a"), (3, "a"), (4, None), (None, "z")], "k long, attr string"
    )
    assert rows(fast(fact, dim)) == rows(naive(fact, dim))
    by_g = [("g", F.col("g"))]
    assert rows(fast(fact, dim, by_g)) == rows(naive(fact, dim, by_g))


def test_preaggregation_rejects_non_decomposable(spark):
    df = spark.createDataFrame([(1, 1)], "k long, x long")
    with pytest.raises(ValueError):
        dim_totals(df, df, "k", "k", [], [("d", "count_distinct", "x")])


SKEW_CONF = {
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.mark.parametrize("algorithm", ["SortMergeJoin", "ShuffledHashJoin"])
def test_reports_survive_skew_split(spark, algorithm):
    """Force shuffle joins and AQE skew splitting; results must not change."""
    star = cat.star(spark, SF_CHECK)
    # A hot key: a third of the sales moved onto customer 1, on top of the
    # NULL keys that all land in one partition of the left join.
    hot = star.fact_sales.withColumn(
        "customer_key",
        F.when(F.col("order_number") % 3 == 0, F.lit(1)).otherwise(F.col("customer_key")),
    )
    queries = {
        "report": lambda: cat.rep.report_customers(hot, star.dim_customers, cat.AS_OF),
        "segments": lambda: cat.seg.segment_counts(hot, star.dim_customers, cat.MIN_MONTHS, cat.VIP_SPENDING),
    }
    expected = {k: rows(q()) for k, q in queries.items()}
    conf = dict(SKEW_CONF)
    if algorithm == "ShuffledHashJoin":
        conf["spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"] = "1g"
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name, q in queries.items():
            df = q()
            assert rows(df) == expected[name], name
            final = plan_text(df)
            assert "isFinalPlan=true" in final
            assert algorithm in final and "BroadcastHashJoin" not in final
            if name == "report":
                # the fact side of fact LEFT JOIN customers was split
                assert f"{algorithm}(skew=true) LeftOuter" in final, final[:3000]
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_product_side_operators_survive_a_hot_product(spark):
    star = cat.star(spark, SF_CHECK)
    hot_key = star.dim_products.agg(F.min("product_key")).first()[0]
    hot = star.fact_sales.withColumn(
        "product_key",
        F.when(F.col("order_number") % 3 == 0, F.lit(hot_key)).otherwise(F.col("product_key")),
    )
    queries = {
        "report": lambda: cat.rep.report_products(hot, star.dim_products, cat.AS_OF, cat.HIGH_PERFORMER, cat.MID_RANGE),
        "yoy": lambda: cat.perf.yearly_performance(hot, star.dim_products),
        "categories": lambda: cat.ctb.contribution(
            cat.ctb.part_totals(hot, star.dim_products, "product_key", "product_key", ["category"]), places=2
        ),
    }
    expected = {k: rows(q()) for k, q in queries.items()}
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        for name, q in queries.items():
            df = q()
            assert rows(df) == expected[name], name
            assert "BroadcastHashJoin" not in plan_text(df)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
