"""Text helpers with the reference's CONCAT rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from starlens.functions.columns import as_col


def concat_text(*parts: Column | str) -> Column:
    """CONCAT that reads NULL as '' (Spark's ``concat`` returns NULL instead).

    ``concat_text(first, lit(' '), last)`` with a null first name gives
    ``' Smith'``, as the reference does.
    """
    return F.concat(*[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts])


def full_name(first: Column | str, last: Column | str) -> Column:
    return concat_text(first, F.lit(" "), last)


def short_number(x: Column | str, places: int) -> Column:
    """Render ``round(x, places)`` in short form: ``96.4``, ``100``, ``0.0001``, ``0``.

    Going through a fixed-scale decimal avoids the scientific notation of
    double-to-string (``1.0E-4``); trailing zeros and a bare point are then
    removed.
    """
    rounded = F.round(as_col(x), places).cast(DecimalType(38, places)).cast("string")
    if places <= 0:
        return rounded
    return F.regexp_replace(rounded, r"\.?0+$", "")


def pct_label(share: Column | str, places: int) -> Column:
    """CONCAT(ROUND(share, places), '%'); a NULL share gives just ``'%'``."""
    return concat_text(short_number(share, places), F.lit("%"))
