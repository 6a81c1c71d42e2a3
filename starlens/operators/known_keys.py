"""Which sales have a dimension row, decided where they are read: a membership filter of the known keys.

In a left join to a large dimension every sale is shuffled only to learn whether
its key is known. Here the dimension's keys become words of 64 bits
(:mod:`starlens.operators.distinct_bitmaps`); a sale finds its word by number and tests
its bit, both map-side, and gets its *grain key*: its own key where that is known, else
NULL. Matched sales then aggregate by their key, and unmatched ones as one group of
their own, before anything is joined or shuffled. The bitmap is exact, so there is
nothing to check again.

Size: a whole-number key takes at most ``min(keys, (max - min) / 64 + 1)`` words, which one
aggregate of the dimension's key column tells beforehand. Only words within
``MOST_WORDS`` (64 MB at 16 bytes a word, 268 million keys that lie close together) are
broadcast. Beyond it, and for keys that aren't whole numbers, :func:`grain_sales`
returns None, and the caller joins (:func:`starlens.operators.reports.report_products`) or
aggregates words first (:func:`starlens.operators.reports.report_products_from_bitmaps`).

Defined results: a NULL key is unknown; an empty dimension makes every key unknown; a
key that the dimension repeats is known once, so a sale is never repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.functions.numeric import is_integral
from starlens.operators.distinct_bitmaps import BITS, WORD, WORD_BITS, bit_of, set_words, word_of

MOST_WORDS = 1 << 22


def word_bound(dim: DataFrame, key: str) -> int:
    """The most words that the dimension's keys can take; one aggregate of one column."""
    code = F.col(key).cast("long")
    # as decimals: the span of longs may pass 64 bits
    low, high = (F.floor(how(code).cast("decimal(38,0)") / F.lit(1 << WORD_BITS)) for how in (F.min, F.max))
    row = dim.agg(F.count(key).alias("n"), (high - low + 1).cast("decimal(38,0)").alias("span")).first()
    return min(row["n"], int(row["span"])) if row["n"] else 0


def known_words(dim: DataFrame, key: str) -> DataFrame:
    """(word, bits) of the dimension's keys."""
    return set_words(dim.where(F.col(key).isNotNull()), [], F.col(key).cast("long"))


def grain_sales(fact: DataFrame, dim: DataFrame, key: str, out: str, most_words: int = MOST_WORDS) -> DataFrame | None:
    """``fact`` with column ``out``: its ``key`` where ``dim`` has it, else NULL; None if the filter would be too large.

    The fact isn't shuffled and no row is added or lost.
    """
    if not (is_integral(fact, key) and is_integral(dim, key)) or word_bound(dim, key) > most_words:
        return None
    words = known_words(dim, key).select(F.col(WORD).alias("__known_word"), F.col(BITS).alias("__known_bits"))
    # at most most_words rows, checked above
    tested = fact.join(F.broadcast(words), word_of(key) == F.col("__known_word"), "left")
    known = F.col("__known_bits").bitwiseAND(bit_of(key)) != 0
    return tested.withColumn(out, F.when(known, F.col(key).cast(dim.schema[key].dataType))).drop("__known_word", "__known_bits")
