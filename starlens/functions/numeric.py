"""Arithmetic with the reference's rules, which follow the operands' types.

- whole / whole truncates toward zero (Spark ``/`` would give a double); any
  other division is the ordinary one.
- AVG over whole numbers is whole, the truncated quotient of SUM and COUNT; over
  decimals and doubles it is the ordinary mean.
- A zero divisor gives NULL instead of an error (ANSI mode raises).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import WindowSpec

from starlens.functions.columns import as_col


def zero_to_null(c: Column | str) -> Column:
    """NULLIF(c, 0)."""
    return F.nullif(as_col(c), F.lit(0))


def int_div(a: Column | str, b: Column | str) -> Column:
    """Integer division truncating toward zero; NULL when ``b`` is 0 or NULL."""
    return F.call_function("div", as_col(a), zero_to_null(b))


def is_integral(df: DataFrame, column: str) -> bool:
    """Whether the column holds whole numbers (any width)."""
    return isinstance(df.schema[column].dataType, IntegralType)


def quotient(a: Column | str, b: Column | str, integral: bool) -> Column:
    """``a / b``, truncated when ``integral`` says that ``a`` is whole (``b`` is a count); NULL for a zero divisor."""
    return int_div(a, b) if integral else as_col(a) / zero_to_null(b)


def ratio(a: Column | str, b: Column | str) -> Column:
    """Floating-point ``a / b`` with a zero divisor mapped to NULL."""
    return as_col(a).cast("double") / zero_to_null(b)


def avg_of(
    c: Column | str, mode: str = "truncate", over: WindowSpec | None = None, integral: bool = True
) -> Column:
    """AVG with the reference's semantics for the input's type.

    ``mode="truncate"``: over whole numbers (``integral``) SUM div COUNT of the
    non-null values, else the ordinary mean. ``mode="exact"``: the ordinary
    mean for any type. With ``over`` the same is computed as a window aggregate.
    """
    if mode not in ("truncate", "exact"):
        raise ValueError("mode must be 'truncate' or 'exact'")
    c = as_col(c)
    if mode == "exact" or not integral:
        return F.avg(c) if over is None else F.avg(c).over(over)
    total, count = F.sum(c), F.count(c)
    if over is not None:
        total, count = total.over(over), count.over(over)
    return int_div(total, count)


#: Decimal places that :func:`stable_avg` keeps of each value.
STABLE_PLACES = 12


def stable_avg(c: Column) -> Column:
    """The mean of doubles, the same for every partitioning.

    A distributed SUM of doubles depends on the order in which partial sums meet.
    Here each value is taken to 12 decimal places as a whole number, whose
    38-digit sum is exact in any order (up to 10^26 in all), and only the
    quotient is a double.
    """
    return units_mean(F.sum(stable_units(c)), F.count(c))


def stable_units(c: Column) -> Column:
    """The value in whole units of 10^-12, for sums that merge exactly."""
    return F.round(c * F.lit(10.0**STABLE_PLACES), 0).cast("decimal(38,0)")


def units_mean(total: Column | str, count: Column | str) -> Column:
    """The mean from a sum of :func:`stable_units` and a count; NULL for none."""
    return as_col(total).cast("double") / zero_to_null(count) / F.lit(10.0**STABLE_PLACES)
