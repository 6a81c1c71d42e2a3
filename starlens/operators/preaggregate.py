"""Aggregate the fact by its own key *before* joining a dimension.

``SELECT d.attrs, SUM(f.x) FROM fact f LEFT JOIN dim d ON f.k = d.k GROUP BY d.attrs``
joins every fact row to the dimension. For decomposable aggregates (SUM,
MIN, MAX, COUNT) the same result comes from:

1. aggregating the fact by ``(f.k, fact-side keys)`` (map-side partial
   aggregation first, so a hot key costs one row per task),
2. left-joining that per-key aggregate to the dimension,
3. re-aggregating by the dimension attributes (SUM of sums and counts,
   MIN of mins, MAX of maxes).

This is exact for any dimension: a dimension row matching key ``k`` sees
the total of ``k``'s fact rows once, exactly as it would see each row in the
row-level join, and keys with no dimension row (or a NULL key) still fall
into the all-NULL group. The join and the final aggregate then run on
per-key rows instead of fact rows, and the fact-level shuffle carries only
the narrow key and partial sums.

It pays off when each fact key carries many rows (per product or per
customer totals). When the pre-aggregation key is nearly unique per fact
row (e.g. (month, product)), aggregating by the dimension attribute directly
after the join is cheaper, and the operators do that instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTIAL = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
_MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}

Measure = tuple[str, str, Column | str]  # (alias, kind, fact column or expression)


def dim_totals(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    dim_cols: Sequence[tuple[str, str]],
    measures: Sequence[Measure],
    fact_cols: Sequence[tuple[str, Column]] = (),
) -> DataFrame:
    """Aggregate ``measures`` over ``fact LEFT JOIN dim`` grouped by ``fact_cols`` + ``dim_cols``.

    - ``dim_cols``: ``(output name, dimension column)`` pairs forming the
      grouping attributes taken from the dimension side.
    - ``fact_cols``: ``(output name, expression over fact columns)`` pairs,
      e.g. a period bucket, grouped on as well.
    - ``measures``: ``(output name, kind, column)`` with kind one of
      ``sum``, ``min``, ``max``, ``count``.
    """
    for _, kind, _ in measures:
        if kind not in _PARTIAL:
            raise ValueError(f"not decomposable: {kind!r}")
    fkey = "__fact_key"
    per_key = fact.groupBy(F.col(fact_key).alias(fkey), *[e.alias(n) for n, e in fact_cols]).agg(
        *[_PARTIAL[kind](c).alias(name) for name, kind, c in measures]
    )
    dkey = "__dim_key"
    attrs = dim.select(F.col(dim_key).alias(dkey), *[F.col(c).alias(n) for n, c in dim_cols])
    joined = per_key.join(attrs, F.col(fkey) == F.col(dkey), "left")
    return joined.groupBy(*[n for n, _ in fact_cols], *[n for n, _ in dim_cols]).agg(
        *[_MERGE[kind](name).alias(name) for name, kind, _ in measures]
    )
