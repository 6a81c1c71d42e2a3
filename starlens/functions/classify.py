"""Searched CASE builders for labels and bands.

A searched CASE takes the first matching branch; a NULL input matches no
comparison and falls to the default, exactly like SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlens.functions.columns import as_col


def first_match(branches: Sequence[tuple[Column, object]], default: object) -> Column:
    """CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE default END."""
    if not branches:
        return F.lit(default)
    cond, value = branches[0]
    expr = F.when(cond, value)
    for cond, value in branches[1:]:
        expr = expr.when(cond, value)
    return expr.otherwise(default)


# Fixed values of the reference: band label formats ("Below 100",
# "100-500", "Above 1000" for edges 100, 500, 1000).
BELOW, BETWEEN, ABOVE = "Below {}", "{}-{}", "Above {}"


def _fmt(edge: float) -> str:
    return f"{edge:g}"


def range_band(value: Column | str, edges: Sequence[float]) -> Column:
    """Bands ``Below e0``, ``e0-e1``, ... ``Above eN`` with inclusive BETWEEN edges.

    Edges are shared by neighbouring bands; the first match wins, so a value
    equal to an inner edge lands in the lower band. NULL lands in ``Above eN``.
    """
    if not edges:
        raise ValueError("at least one edge is required")
    v = as_col(value)
    branches = [(v < edges[0], BELOW.format(_fmt(edges[0])))]
    for lo, hi in zip(edges, edges[1:]):
        branches.append((v.between(lo, hi), BETWEEN.format(_fmt(lo), _fmt(hi))))
    return first_match(branches, ABOVE.format(_fmt(edges[-1])))


def band_labels(edges: Sequence[float]) -> list[str]:
    """All labels :func:`range_band` can produce, in ascending order."""
    labels = [BELOW.format(_fmt(edges[0]))]
    labels += [BETWEEN.format(_fmt(lo), _fmt(hi)) for lo, hi in zip(edges, edges[1:])]
    return labels + [ABOVE.format(_fmt(edges[-1]))]


def sign_label(diff: Column | str, positive: str, negative: str, zero: str) -> Column:
    """Label the sign of a difference; NULL (no previous value) counts as ``zero``."""
    d = as_col(diff)
    return first_match([(d > 0, positive), (d < 0, negative)], zero)
