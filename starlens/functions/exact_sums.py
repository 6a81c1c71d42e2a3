"""Correctly rounded sums and means of doubles, the same for every partitioning.

A finite double is a whole number of 53 bits times a power of two. Each value
becomes a whole number of units ``2^s``, where ``s`` is fixed by its size in steps of
``2^8``; units of one step are added as whole numbers (exact in any order), and at
most 263 step sums per key, whatever the number of rows, are put together and
rounded once. So ``1e300, 1, -1e300`` add up to 1, and no range of values is too
wide (:func:`starlens.functions.numeric.stable_avg` keeps 12 decimal places).

NULLs are skipped, and a key without values has the sum and mean NULL. NaN gives NaN,
infinities of one sign give that infinity, of both signs NaN. A sum beyond the
largest double is infinite; a mean of such values need not be.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from starlens.functions.columns import as_col, as_cols

STEP = 8
#: The smallest double is 2^-1074, so no unit needs to be finer.
FINEST = -1074


def step_of(x: Column) -> Column:
    """The exponent of the unit of a finite value; whichever of two neighbouring steps, the units are whole."""
    fine = F.floor((F.floor(F.log2(F.abs(x))) - 53) / STEP) * STEP
    return F.when(x == 0, F.lit(0)).otherwise(F.greatest(fine, F.lit(FINEST))).cast("int")


def units_of(x: Column, step: Column) -> Column:
    """``x / 2^step``: a whole number below 2^63. Two exact products, since 2^-step may be beyond a double."""
    half = F.floor(-step / F.lit(2)).cast("int")
    return (x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), -step - half)).cast("long")


def _rounded(steps, units, count: int) -> float:
    """``sum(units * 2^steps) / count``, rounded once: true division of whole numbers is correctly rounded."""
    low = min(steps)
    total = sum(int(u) << (s - low) for s, u in zip(steps, units))
    top, bottom = (total << low, count) if low >= 0 else (total, count << -low)
    try:
        return top / bottom
    except OverflowError:
        return float("inf") if total > 0 else float("-inf")


@F.pandas_udf(DoubleType())
def _rounded_quotients(steps: pd.Series, units: pd.Series, counts: pd.Series) -> pd.Series:
    found = [_rounded([int(s) for s in ss], uu, int(n)) if n and len(ss) else None for ss, uu, n in zip(steps, units, counts)]
    return pd.Series(found, dtype="Float64").astype("object")


def exact_totals(
    df: DataFrame,
    keys: Sequence[Column | str] | Column | str | None,
    value: Column | str,
    total: str = "total",
    mean: str | None = None,
    count: str | None = None,
) -> DataFrame:
    """One row per ``keys`` (one row in all without keys) with the correctly rounded sum, mean and count of ``value``.

    Two hash aggregates with partial sums, on (keys, step) and on keys; only the last
    step, over at most 263 numbers per result row, is done outside the JVM.
    """
    keys = as_cols(keys)
    names = [f"__key{i}" for i in range(len(keys))]
    wanted = df.select(*keys).columns
    x = as_col(value).cast("double")
    rows = df.select(*(k.alias(n) for k, n in zip(keys, names)), x.alias("__x"))
    odd = F.isnan("__x") | (F.abs("__x") == float("inf"))
    finite = F.when(~odd, F.col("__x"))
    # no step for NULL and unusual values, which have a row of their own
    stepped = rows.withColumn("__step", F.when(finite.isNotNull(), step_of(F.col("__x"))))
    units = F.when(F.col("__step").isNotNull(), units_of(F.col("__x"), F.col("__step"))).cast("decimal(38,0)")
    by_step = stepped.groupBy(*names, "__step").agg(
        F.sum(units).alias("__units"),
        F.count("__x").alias("__count"),
        F.sum(F.when(odd, F.col("__x"))).alias("__odd"),
    )
    steps = F.when(F.col("__step").isNotNull(), F.struct(F.col("__step").alias("s"), F.col("__units").alias("u")))
    by_key = by_step.groupBy(*names).agg(
        F.collect_list(steps).alias("__steps"),
        F.coalesce(F.sum("__count"), F.lit(0)).alias("__count"),
        F.max("__odd").alias("__odd"),  # one row of a key has it
    )
    lists = F.col("__steps.s"), F.col("__steps.u")

    def rounded(divisor: Column) -> Column:
        found = _rounded_quotients(*lists, divisor.cast("long"))
        return F.coalesce(F.col("__odd"), F.when(F.col("__count") > 0, found))

    out = [F.col(n).alias(w) for n, w in zip(names, wanted)]
    out.append(rounded(F.lit(1)).alias(total))
    if mean is not None:
        out.append(rounded(F.col("__count")).alias(mean))
    if count is not None:
        out.append(F.col("__count").alias(count))
    return by_key.select(*out)
