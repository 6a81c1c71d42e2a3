"""Running sums and counts over rows of any grain, without a single-task window.

A window without PARTITION BY runs in one task, which is fine for a series of months
(:mod:`starlens.operators.cumulative`) and not for order lines. Here the scan is
distributed:

1. rows are summed per (partition, order key), so peers, even a third of all rows
   on one day, become one row before any shuffle (partial sums);
2. those rows are range-partitioned on (partition, order key) into blocks and written;
   a window inside each block gives the sums from the block's start;
3. the blocks' totals, one row per block and partition, give what earlier blocks
   carry into each;
4. the sums meet the rows again by an equality join, in which AQE splits a hot key.

The result is that of ``SUM(x) OVER ([PARTITION BY p] ORDER BY k)`` with the default
frame: peers share a value, NULL order keys come first, NULL values are skipped and a
frame without values has the sum NULL. Sums of whole numbers and decimals are equal to
the window's; sums of doubles may differ in their last digits (blocks are added first).
Rows are kept as they are, repeated ones too; an empty input gives an empty result.
``rows`` is read twice: pass a table, or write a long derivation first.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.functions.columns import as_cols
from starlens.functions.numeric import int_div, is_integral
from starlens.session import writable_root

_AT, _BLOCK = "__scan_at", "__scan_block"


def _both(a: Column, b: Column) -> Column:
    """The sum of two sums, of which either may be that of no values."""
    return F.coalesce(a + b, a, b)


def prefix_sums(
    rows: DataFrame,
    order_by: str,
    measures: Sequence[str],
    partition_by: Sequence[Column | str] | Column | str | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """``rows`` with ``<measure>__sum`` and ``<measure>__count`` up to each row and its peers.

    ``blocks`` is the number of range partitions, by default the session's shuffle
    partitions. The only one-task step orders one row per block.
    """
    spark = rows.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = as_cols(partition_by)
    names = [f"__scan_part{i}" for i in range(len(parts))]
    outs = [out for m in measures for out in (f"{m}__sum", f"{m}__count")]
    if clash := set(outs) & set(rows.columns):
        raise ValueError(f"columns {sorted(clash)} exist already")

    keyed = [p.alias(n) for p, n in zip(parts, names)]
    values = rows.select(*keyed, F.col(order_by).alias(_AT), *(F.col(m).alias(f"__scan_x{i}") for i, m in enumerate(measures)))
    sums = [how(f"__scan_x{i}").alias(f"{m}__{kind}") for i, m in enumerate(measures) for kind, how in (("sum", F.sum), ("count", F.count))]
    peers = values.groupBy(*names, _AT).agg(*sums)
    types = {c: peers.schema[c].dataType for c in outs}
    placed = peers.repartitionByRange(blocks, *names, _AT).withColumn(_BLOCK, F.spark_partition_id())
    path = f"{writable_root(spark)}/starlens/scans/{uuid.uuid4().hex}"
    placed.write.parquet(path)  # the blocks stay as they are, whichever task is run again
    stored = spark.read.schema(placed.schema).parquet(path)

    inside = Window.partitionBy(_BLOCK, *names).orderBy(F.col(_AT).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*names).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    totals = stored.groupBy(_BLOCK, *names).agg(*(F.sum(c).alias(c) for c in outs))
    renamed = [F.col(n).alias(f"{n}_c") for n in names]
    carried = totals.select(F.col(_BLOCK).alias("__scan_to"), *renamed, *(F.sum(c).over(earlier).alias(f"{c}_c") for c in outs))
    same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"{n}_c")) for n in names], F.col(_BLOCK) == F.col("__scan_to"))
    if not names:
        carried = F.broadcast(carried)  # one row per block
    local = stored.select(*names, _AT, _BLOCK, *(F.sum(c).over(inside).alias(c) for c in outs))
    scanned = local.join(carried, same, "left").select(
        *names, _AT, *(_both(F.col(c), F.col(f"{c}_c")).cast(types[c]).alias(c) for c in outs)
    )

    found = reduce(Column.__and__, [p.eqNullSafe(F.col(n)) for p, n in zip(parts, names)], F.col(order_by).eqNullSafe(F.col(_AT)))
    return rows.join(scanned, found, "left").drop(*names, _AT)


def running_rows(
    rows: DataFrame,
    order_by: str,
    totals: dict[str, str] | None = None,
    averages: dict[str, str] | None = None,
    partition_by: Sequence[Column | str] | Column | str | None = None,
    mode: str = "truncate",
    blocks: int | None = None,
) -> DataFrame:
    """``rows`` with running totals and expanding means, ``{new column: measure}``, at their own grain.

    ``mode`` is that of :func:`starlens.operators.cumulative.expanding_avg`: ``truncate``
    keeps the mean of whole numbers whole, ``exact`` divides.
    """
    if mode not in ("truncate", "exact"):
        raise ValueError("mode must be 'truncate' or 'exact'")
    totals, averages = totals or {}, averages or {}
    measures = list(dict.fromkeys([*totals.values(), *averages.values()]))
    if not measures:
        return rows
    out = prefix_sums(rows, order_by, measures, partition_by, blocks)

    def mean(m: str) -> Column:
        total, count = F.col(f"{m}__sum"), F.col(f"{m}__count")
        if mode == "truncate" and is_integral(rows, m):
            return int_div(total, count)
        return total.cast("double") / F.nullif(count, F.lit(0))

    columns = {new: F.col(f"{m}__sum") for new, m in totals.items()} | {new: mean(m) for new, m in averages.items()}
    return out.withColumns(columns).drop(*(f"{m}__{k}" for m in measures for k in ("sum", "count")))
