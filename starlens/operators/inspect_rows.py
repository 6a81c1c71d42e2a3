"""Row-level inspection: previews and null audits.

``SELECT TOP n *`` without ORDER BY returns any n rows and stops reading once it
has them; so does :func:`preview`. With an order it plans as
TakeOrderedAndProject (a per-task top-n, then a merge of n rows per task), which
reads the whole table but never sorts or moves it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] | None = None) -> DataFrame:
    """``n`` rows: any without ``order_by``, else the first by those columns (NULL first).

    Ordering by all columns (``order_by=df.columns``) makes a preview reproducible.
    """
    if not order_by:
        return df.limit(n)
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).limit(n)


def null_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` IS NULL (e.g. undated sales), all columns."""
    return df.filter(F.col(col).isNull())
