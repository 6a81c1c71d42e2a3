"""Part-to-whole: each part's total, the grand total and its percentage share.

The reference attaches the grand total with ``SUM(x) OVER ()``. In Spark a
window without PARTITION BY moves every row into a single task, which does
not scale to one row per customer. Here the grand total is a scalar
subquery over the same per-part aggregate: its partial sums pass through a
single partition (one row per task), and the per-part rows stay
distributed. Under AQE the subquery reuses the per-part aggregate's
shuffle instead of recomputing it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.functions.numeric import ratio
from starlens.functions.text import pct_label
from starlens.operators.preaggregate import dim_totals


def part_totals(
    fact: DataFrame,
    dim: DataFrame | None,
    fact_key: str,
    dim_key: str,
    part_cols: Sequence[str],
    measure_col: str = "sales_amount",
    measure: str = "total_sales",
) -> DataFrame:
    """SUM(measure) per part, where the part columns come from the dimension.

    Sales whose key has no dimension row fall into the all-NULL part. No
    date filter is applied: undated sales still belong to the whole. The
    fact is summed per key before the dimension join (exact for SUM).
    """
    if dim is None:
        return fact.groupBy(*part_cols).agg(F.sum(measure_col).alias(measure))
    return dim_totals(
        fact, dim, fact_key, dim_key, [(c, c) for c in part_cols], [(measure, "sum", measure_col)]
    )


def overall_total(fact: DataFrame, measure_col: str = "sales_amount", alias: str = "overall_sales") -> DataFrame:
    """The grand total as a one-row DataFrame."""
    return fact.agg(F.sum(measure_col).alias(alias))


def contribution(
    parts: DataFrame,
    measure: str = "total_sales",
    places: int = 2,
    label: str = "percentage_of_total",
    total: str = "overall_sales",
    sort_by: str | None = "share",
) -> DataFrame:
    """Add the grand total and ``CONCAT(ROUND(measure / total * 100, places), '%')``.

    ``sort_by``: ``"share"`` sorts by the numeric share (descending),
    ``"label"`` by the text label as the reference's customer query does
    (so ``9.5%`` ranks above ``10.1%``), ``"measure"`` by the part total,
    ``None`` leaves the rows unsorted.

    The reference leaves the order within ties open. Here ties are broken by
    the measure and then the part columns: with one row per customer almost
    every share rounds to the same few labels, and a range-partitioned sort
    cannot split equal keys, so without tiebreakers one task would sort
    nearly all rows.
    """
    grand = parts.agg(F.sum(measure)).scalar()
    share = ratio(measure, grand) * 100
    out = parts.select(
        *parts.columns,
        grand.alias(total),
        pct_label(share, places).alias(label),
    )
    keys = [F.col(c).asc_nulls_first() for c in parts.columns if c != measure]
    if sort_by == "share":
        return out.orderBy(ratio(measure, total).desc(), *keys)
    if sort_by == "label":
        return out.orderBy(F.col(label).desc(), F.col(measure).desc(), *keys)
    if sort_by == "measure":
        return out.orderBy(F.col(measure).desc(), *keys)
    return out
