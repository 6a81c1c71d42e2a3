"""Incremental refresh: reads new files only, equals a full run, counts nothing twice."""

import os

import pytest
from pyspark.sql import functions as F

from starlens.operators import increments as inc
from starlens.operators import reports as rep
from starlens.plans import catalog as cat
from tests.conftest import SF_SMALL


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def star(spark):
    return cat.star(spark, SF_SMALL)


def append(star, folder, part, of=4):
    """One of ``of`` disjoint parts of the sales, by line and not by key, as further files."""
    share = star.fact_sales.where(F.pmod(F.xxhash64(*star.fact_sales.columns), F.lit(of)) == part)
    share.coalesce(1).write.mode("append").parquet(folder)


def check(spark, star, folder, state):
    fact = spark.read.parquet(folder)
    want = rep.report_products(fact, star.dim_products, cat.AS_OF), rep.report_customers(fact, star.dim_customers, cat.AS_OF)
    assert rows_of(state.report_products(star.dim_products, cat.AS_OF)) == rows_of(want[0])
    assert rows_of(state.report_customers(star.dim_customers, cat.AS_OF)) == rows_of(want[1])


def test_appended_files_are_all_that_is_read(spark, star, scratch, monkeypatch):
    folder, root = f"{scratch}/fact", f"{scratch}/state"
    append(star, folder, 0)
    assert inc.refresh(spark, folder, root).files_read == 1
    append(star, folder, 1)
    state = inc.refresh(spark, folder, root)
    assert state.files_read == 1 and len(state.steps) == 2
    check(spark, star, folder, state)
    assert inc.refresh(spark, folder, root).files_read == 0
    # beyond the bound all steps are merged into one
    monkeypatch.setattr(inc, "MOST_STEPS", 2)
    append(star, folder, 2)
    merged = inc.refresh(spark, folder, root)
    assert merged.files_read == 1 and len(merged.steps) == 1
    check(spark, star, folder, merged)
    assert inc.remove_unused_steps(spark, root) == 3
    check(spark, star, folder, inc.open_state(spark, root))


def test_a_failed_refresh_counts_nothing_twice(spark, star, scratch, monkeypatch):
    folder, root = f"{scratch}/fact", f"{scratch}/state"
    append(star, folder, 0)
    inc.refresh(spark, folder, root)
    append(star, folder, 1)
    with monkeypatch.context() as m:
        m.setattr(inc, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            inc.refresh(spark, folder, root)  # its step is written, its manifest isn't
    state = inc.refresh(spark, folder, root)
    assert state.files_read == 1 and len(state.steps) == 2
    check(spark, star, folder, state)
    assert inc.remove_unused_steps(spark, root) == 1


def test_a_removed_file_starts_anew(spark, star, scratch):
    folder, root = f"{scratch}/fact", f"{scratch}/state"
    for part in (0, 1):
        append(star, folder, part)
    inc.refresh(spark, folder, root)
    files = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    os.remove(f"{folder}/{files[0]}")
    state = inc.refresh(spark, folder, root)
    assert state.files_read == 1 and len(state.steps) == 1
    check(spark, star, folder, state)


def test_text_order_numbers_are_an_error(spark, star, scratch):
    fact = star.fact_sales.limit(5).withColumn("order_number", F.col("order_number").cast("string"))
    fact.write.parquet(f"{scratch}/fact")
    with pytest.raises(ValueError, match="order_number"):
        inc.refresh(spark, f"{scratch}/fact", f"{scratch}/state")


def test_words_carry_no_sums(spark, star):
    """There may be as many words as sales, so sums have one row per key of their own."""
    for grain in inc.GRAINS:
        orders, others, sums = rep.sales_words(star.fact_sales, grain)
        assert orders.columns == others.columns == [grain, "__word", "__bits"]
        assert sums.count() == star.dated_sales().select(grain).distinct().count()
