"""Exact distinct counts that merge: bitmaps over a whole-number code of the key.

A set of keys is kept as words of 64 bits: word number ``code >> 6``, bit
``code & 63``. A set is built with ``bit_or`` of single bits, two sets unite with
``bit_or`` of their words, and a count is the sum of ``bit_count``. So a month's
customers OR into a year's, and sets of two columns are counted in one result
without an ``Expand`` of the input.

Memory: a word is 8 bytes, with its number and group key about 40 bytes of an
aggregation buffer. A group takes at most as many words as it has distinct
keys, and at most ``keys / 64`` where its keys lie close together. All aggregates
are hash aggregates with partial sums; a hot group is spread over its words.

Whole-number keys are their own code (surrogate keys lie close together). Any
other key, such as a text order number, gets one from :func:`dense_codes`, which
numbers the distinct values 0 .. n-1 without a gap.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.functions.columns import as_col
from starlens.functions.numeric import is_integral
from starlens.session import writable_root

WORD_BITS = 6
WORD, BITS = "__word", "__bits"
# monotonically_increasing_id: the task's number above, the row's number within the task below
_ROW_BITS = 33


def word_of(code: Column | str) -> Column:
    return F.shiftright(as_col(code).cast("long"), WORD_BITS)


def bit_of(code: Column | str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), as_col(code).cast("long").bitwiseAND((1 << WORD_BITS) - 1).cast("int"))


def union_of(bits: Column | str) -> Column:
    """Aggregate: the union of sets' words (or of single bits)."""
    return F.bit_or(as_col(bits))


def size_of(bits: Column | str) -> Column:
    """Aggregate: the number of keys in words of different numbers; 0 for none."""
    return F.coalesce(F.sum(F.bit_count(as_col(bits))), F.lit(0)).cast("long")


def dense_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code) of the distinct non-null values, numbered 0 .. n-1, written to the shared folder.

    Tasks number their own values; the offsets are a running sum over one row per task.
    """
    spark = df.sparkSession
    values = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    path = f"{writable_root(spark)}/starlens/codes/{uuid.uuid4().hex}"
    values.withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.schema(f"value {df.schema[column].dataType.simpleString()}, at long").parquet(path)
    task, row = F.shiftright("at", _ROW_BITS), F.col("at").bitwiseAND((1 << _ROW_BITS) - 1)
    tasks = numbered.groupBy(task.alias("task")).agg(F.count("*").alias("many"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tasks.select("task", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("offset"))
    # one row per task of the numbering, whatever the number of values
    return numbered.join(F.broadcast(offsets), task == F.col("task")).select("value", (F.col("offset") + row).alias("code"))


def with_code(df: DataFrame, column: str, code: str, codes: DataFrame | None = None) -> DataFrame:
    """``df`` with a long column ``code`` for ``column``: the key itself if whole, else from ``codes`` (made here if not given)."""
    if is_integral(df, column):
        return df.withColumn(code, F.col(column).cast("long"))
    found = (dense_codes(df, column) if codes is None else codes).select(
        F.col("value").alias(f"{code}_value"), F.col("code").alias(code)
    )
    return df.join(found, F.col(column) == F.col(f"{code}_value"), "left").drop(f"{code}_value")


def set_words(df: DataFrame, keys: Sequence[Column | str], code: Column | str, *merged: Column) -> DataFrame:
    """One row per (keys, word) with the word's bits; ``merged`` are further aggregates, e.g. sums, of the same rows."""
    return df.groupBy(*keys, word_of(code).alias(WORD)).agg(union_of(bit_of(code)).alias(BITS), *merged)


def coarser(words: DataFrame, keys: Sequence[Column | str], *merged: Column) -> DataFrame:
    """Sets of a finer grain united into those of a coarser one; still one row per (keys, word)."""
    return words.groupBy(*keys, WORD).agg(union_of(BITS).alias(BITS), *merged)


def sizes(words: DataFrame, keys: Sequence[Column | str], out: str, *merged: Column) -> DataFrame:
    """One row per ``keys`` with the number of distinct codes, and further aggregates."""
    return words.groupBy(*keys).agg(size_of(BITS).alias(out), *merged)
