"""Document fingerprints by winnowing, in DataFrame and SQL functions only.

A text's k-grams of code points are hashed; of every window of w consecutive
hashes the least is selected, the rightmost on ties, and kept with its position.
Any passage of at least ``k + w - 1`` code points that two texts share is
selected alike in both. A text is cut into segments of ``SEGMENT`` window starts
(each with the code points its last window reaches into), so arrays stay small
however long a text is, and an edited text is only hashed from the first
segment that the edit reaches.

A hash and its position are packed into one long: the upper 37 bits are the
hash, the lower 27 bits count down with the position, so the least packed value
is the least hash at its rightmost place. SQL has no fold that yields an array,
so each gram is hashed from its own code points, k being constant.

Defined results: a null text counts as empty; an empty text has no hashes (an
empty fingerprint, like 1.0 to another empty one and 0.0 to others); a text
shorter than k is one gram, one with fewer than w grams one window; rows are
ordered by id, null ids last, and rows of one id by a hash of their texts; the
document after the last is the first (a single document is its own next); repeated rows get a row each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.llm.common import written

SEGMENT = 512
POSITION_BITS = 27
POSITIONS = (1 << POSITION_BITS) - 1
#: Rows a bucket of consecutive ids should have, and most ranges that ids are first dealt into.
BUCKET_ROWS = 4096
RANGES = 256
_LAST = (1 << 63) - 1


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _least_of_windows(keys: str, w: int) -> str:
    """The least key of each window of w neighbours, by doubling; the result has a key for each full window."""
    step, parts = 1, []
    while step < w:
        reach = min(step, w - step)
        parts.append(reach)
        step += reach
    expression = "slice(k{n}, 1, greatest(size(k0) - {w} + 1, 1))".format(n=len(parts), w=w)
    for i in range(len(parts) - 1, -1, -1):
        shifted = f"slice(k{i}, {parts[i] + 1}, greatest(size(k{i}) - {parts[i]}, 0))"
        expression = _let(f"k{i + 1}", f"zip_with(k{i}, {shifted}, (x, y) -> least(x, y))", expression)
    return _let("k0", keys, expression)


def segments(points: str, first: str, k: int, w: int) -> str:
    """SQL: the selected (hash, position) longs of each segment from number ``first`` on.

    ``points`` is the text from that segment on as UTF-32 bytes.
    """
    key = (
        f"(xxhash64(substring(seg, 4 * i + 1, {4 * k})) & {-POSITIONS - 1}L)"
        f" | ({POSITIONS}L - ((j + {first}) * {SEGMENT} + i))"
    )
    grams = f"transform(sequence(0, greatest(length(seg) div 4 - {k}, 0)), i -> {key})"
    selected = _let("seg", f"substring(pts, 4 * {SEGMENT} * j + 1, {4 * (SEGMENT + k + w - 2)})", f"array_distinct({_least_of_windows(grams, w)})")
    many = f"greatest(1, cast(ceil((length(pts) div 4 - {k + w - 2}) / {SEGMENT}) as int))"
    each = f"if(length(pts) = 0, cast(array() as array<array<bigint>>), transform(sequence(0, {many} - 1), j -> {selected}))"
    return _let("pts", points, each)


def winnow(text: str, k: int, w: int) -> Column:
    """Per segment of the text column: the selected longs, see ``hashes`` and ``positions``."""
    return F.expr(segments(f"encode({text}, 'UTF-32')", "0", k, w))


def hashes(selected: Column) -> Column:
    """The selected hashes without positions, each once."""
    return F.array_distinct(F.transform(F.flatten(selected), lambda x: F.shiftright(x, POSITION_BITS)))


def positions(selected: Column) -> Column:
    """(hash, position) of each selected gram in order."""
    place = lambda x: F.lit(POSITIONS) - x.bitwiseAND(F.lit(POSITIONS))
    return F.transform(
        F.array_distinct(F.flatten(selected)),
        lambda x: F.struct(F.shiftright(x, POSITION_BITS).alias("hash"), place(x).alias("position")),
    )


def digest(selected: Column) -> Column:
    """A text's fingerprint as a string: 128 bits over its selected hashes and positions, empty for none."""
    flat = F.array_distinct(F.flatten(selected))
    half = lambda seed: F.lpad(F.hex(F.xxhash64(F.lit(seed), flat)), 16, "0")
    return F.when(F.size(selected) == 0, F.lit("")).otherwise(F.lower(F.concat(half(1), half(2))))


def likeness(a: str, b: str) -> Column:
    """Shared share of two sets of hashes (Jaccard)."""
    return F.expr(
        _let(
            "both", f"size(array_intersect({a}, {b}))",
            f"if(size({a}) + size({b}) = 0, 1.0D, cast(both as double) / (size({a}) + size({b}) - both))",
        )
    )


def bucketed(docs: DataFrame) -> DataFrame:
    """``docs`` (columns pos, mark) with ``range`` and ``bucket``: runs of about ``BUCKET_ROWS`` rows in their order.

    Ranges are quantiles of ids; a range is cut evenly into buckets. Rows
    without an id (pos ``_LAST``) follow in buckets of their own, cut evenly
    by mark. Only counts and the quantiles (at most ``RANGES``) come to the
    driver.
    """
    known = F.when(F.col("pos") < _LAST, F.col("pos"))
    rows, named = docs.agg(F.count("*"), F.count(known)).first()
    tail = max(1, -(-(rows - named) // BUCKET_ROWS))
    ranges = max(1, min(RANGES, -(-rows // BUCKET_ROWS)))
    cuts = docs.agg(F.percentile_approx(known, [i / ranges for i in range(ranges + 1)], 10_000)).first()[0] or [0, 1]
    cuts = sorted(set(cuts))
    per_range = max(1, -(-rows // (ranges * BUCKET_ROWS)))
    inner = F.array(*[F.lit(c).cast("long") for c in cuts[1:-1]]) if len(cuts) > 2 else F.expr("cast(array() as array<bigint>)")
    docs = docs.withColumn("range", F.size(F.filter(inner, lambda c: c <= F.col("pos"))))
    low = F.element_at(F.array(*[F.lit(c).cast("double") for c in cuts]), F.col("range") + 1)
    high = F.element_at(F.array(*[F.lit(c).cast("double") for c in [*cuts[1:], cuts[-1] + 1]]), F.col("range") + 1)
    part = F.floor((F.col("pos") - low) * per_range / F.greatest(high - low, F.lit(1.0)))
    by_id = F.least(F.lit(per_range - 1), F.greatest(F.lit(0), part))
    by_mark = F.least(F.lit(tail - 1), F.floor((F.col("mark") / 2.0**64 + 0.5) * tail)) + per_range
    return docs.withColumn("bucket", F.when(F.col("pos") == _LAST, by_mark).otherwise(by_id).cast("int"))


def _follow(firsts: DataFrame) -> DataFrame:
    """For each bucket's first row (pos, mark): the bucket before it, around the end; ``firsts``: range, bucket, pos, mark."""
    inside = Window.partitionBy("range").orderBy("bucket")
    ends = firsts.groupBy("range").agg(F.max("bucket").alias("end"))  # at most RANGES rows
    every = Window.partitionBy(F.lit(1))
    order = every.orderBy("range")
    back = ends.withColumns({"to_range": F.lag("range").over(order), "to_bucket": F.lag("end").over(order)})
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    back = back.withColumns({
        "to_range": F.coalesce("to_range", F.last("range").over(whole)), "to_bucket": F.coalesce("to_bucket", F.last("end").over(whole)),
    }).drop("end")
    before = firsts.withColumn("_lag", F.lag("bucket").over(inside))
    return before.join(back, "range").select(
        F.col("pos").alias("_pos"),
        F.col("mark").alias("_mark"),
        F.when(F.col("_lag").isNull(), F.col("to_range")).otherwise(F.col("range")).alias("_range"),
        F.when(F.col("_lag").isNull(), F.col("to_bucket")).otherwise(F.col("_lag")).alias("_bucket"),
    )


def edited_fingerprints(docs: DataFrame, k: int, w: int) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness to each other and to the next document.

    The edited text has its last quarter of code points replaced by the first as
    many of the next document. Columns: doc_id, n_chars, edited, selected,
    edited_selected, near_edited, near_next. Texts are shuffled once.
    """
    base = bucketed(
        docs.select(
            "doc_id",
            F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("pos"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
        )
    )
    firsts = base.groupBy("range", "bucket").agg(F.min(F.struct("pos", "mark")).alias("least"))
    firsts = written(firsts.select("range", "bucket", "least.pos", "least.mark"), "winnow-buckets")
    guests = (
        base.select("pos", "mark", "text")
        .join(_follow(firsts), (F.col("pos") == F.col("_pos")) & (F.col("mark") == F.col("_mark")))
        .groupBy("_range", "_bucket")
        .agg(F.min("text").alias("guest"))
        .withColumn("guest_hashes", hashes(winnow("guest", k, w)))
    )
    here = Window.partitionBy("range", "bucket").orderBy("pos", "mark", "text")
    rows = base.withColumn("next", F.lead("text").over(here))
    rows = rows.withColumn("selected", winnow("text", k, w)).withColumn("hashes", hashes(F.col("selected")))
    rows = rows.withColumn("next_hashes", F.lead("hashes").over(here))
    last = F.col("next").isNull()
    rows = rows.join(guests, (F.col("range") == F.col("_range")) & (F.col("bucket") == F.col("_bucket")), "left").select(
        "doc_id",
        "text",
        "selected",
        "hashes",
        F.when(last, F.col("guest")).otherwise(F.col("next")).alias("next"),
        F.when(last, F.col("guest_hashes")).otherwise(F.col("next_hashes")).alias("next_hashes"),
        F.length("text").cast("long").alias("n_chars"),
        F.floor(F.length("text") / 4).cast("int").alias("cut"),
    )
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, n_chars - cut), substring(next, 1, cut))")).withColumn(
        # segments whose windows end before the edit are taken over
        "same", F.greatest(F.lit(0), F.floor((F.col("n_chars") - F.col("cut") - F.lit(k + w - 2)) / SEGMENT)).cast("int")
    )
    rest = segments(f"encode(substring(edited, same * {SEGMENT} + 1), 'UTF-32')", "same", k, w)
    # without a full window after them, the segments taken over are all
    done = f"same > 0 and length(edited) - same * {SEGMENT} < {k + w - 1}"
    none = "cast(array() as array<array<bigint>>)"
    rows = rows.withColumn("edited_selected", F.expr(f"concat(slice(selected, 1, same), if({done}, {none}, {rest}))"))
    rows = rows.withColumn("edited_hashes", hashes(F.col("edited_selected")))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        "selected",
        "edited_selected",
        likeness("hashes", "edited_hashes").alias("near_edited"),
        likeness("hashes", "next_hashes").alias("near_next"),
    )
