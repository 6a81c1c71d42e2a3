"""Accept column names or Column expressions interchangeably."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    """A Column for a name or an expression."""
    return F.col(c) if isinstance(c, str) else c


def as_cols(cs: Sequence[Column | str] | Column | str | None) -> list[Column]:
    """A list of Columns for None, one name/expression, or a sequence of them."""
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [as_col(c) for c in cs]
