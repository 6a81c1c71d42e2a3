"""Mixing sources to target shares with a multivariate-hypergeometric splitting tree.

Sources get weights in a repeating cycle; targets share the corpus' words by
weight, no source above ``max_epochs`` times its own words. Every source's
documents stand in a fixed pseudo-random order. A mix takes whole passes over a
source and, for the rest of its target, documents of the next pass that fit.

The draws of a source, in order, form blocks of ``block_docs`` draws. Block
quotas go to output shards by a binary tree: a node splits its counts for all
sources between its halves with one multivariate-hypergeometric draw, seeded by
the node, so shards get exact disjoint quotas with no coordination: any task can
recompute the path to its shard. A shard's documents are then shuffled locally.

Running sums over a source are taken in two levels of 256 buckets of the
order's leading bytes, so a source with most of the rows is never one task.

Defined results: a null text has size 0; null is a source of its own, last in
order; a source without words has target 0; documents of size 0 are never drawn;
repeated rows are documents of their own; an empty table gives an empty result;
other columns are carried by ``mixed`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.llm.common import free_name, written

#: A word of the size rule.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_DOCS = 64
#: Passes that fill what is left of a target with documents that still fit.
FILLS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, source, size, key, mark, order, a, b): size in words, the source's key, its order and the order's buckets."""
    order = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(str(seed))).cast("binary"))
    return docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("key"),
        F.xxhash64("text").alias("mark"),
        order.alias("order"),
    ).withColumns({"a": F.substring("order", 1, 2), "b": F.substring("order", 3, 2)})


def source_targets(docs: DataFrame, max_epochs: int) -> DataFrame:
    """One row a source: key, source_size, target. ``docs`` as ``sized`` gives it; the windows see one row a source."""
    totals = docs.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    every = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = totals.withColumn("weight", (F.row_number().over(every) - 1) % 3 + 1).withColumn(
        "cap", F.col("source_size") * max_epochs
    )
    # Water filling: in order of cap / weight, the first source that stays below its cap sets the level.
    rise = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = rise.rowsBetween(Window.unboundedPreceding, -1)
    onward = rise.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    levels = weighted.withColumns({
        "left": F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "weights": F.sum("weight").over(onward),
    }).withColumn("below", F.col("left") * F.col("weight") <= F.col("cap") * F.col("weights"))
    first = Window.partitionBy(F.lit(1)).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = levels.withColumn("at", F.row_number().over(rise)).withColumns({
        "level_at": F.min(F.when(F.col("below"), F.col("at"))).over(first),
    })
    pick = lambda c: F.max(F.when(F.col("at") == F.col("level_at"), F.col(c))).over(whole)
    levels = levels.withColumns({"level_left": pick("left"), "level_weights": pick("weights")})
    capped = F.col("at") < F.col("level_at")
    shared = (F.col("level_left") * F.col("weight")).cast("double") / F.col("level_weights")
    return levels.select("key", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(shared).alias("target"))


def running(docs: DataFrame, value: Column, name: str) -> DataFrame:
    """``docs`` with the running sum of ``value`` over its source's order, this row included, as ``name``."""
    docs = docs.withColumn("_v", value)
    cells = docs.groupBy("key", "a", "b").agg(F.sum("_v").alias("_s"))
    blocks = cells.groupBy("key", "a").agg(F.sum("_s").alias("_t"))
    earlier = [Window.unboundedPreceding, -1]
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_t").over(Window.partitionBy("key").orderBy("a").rowsBetween(*earlier)), F.lit(0)))
    inner = F.sum("_s").over(Window.partitionBy("key", "a").orderBy("b").rowsBetween(*earlier))
    cells = (
        cells.join(blocks.select("key", "a", "_before"), ["key", "a"])
        .withColumn("_before", F.col("_before") + F.coalesce(inner, F.lit(0)))
        .select("key", "a", "b", "_before")
    )
    own = Window.partitionBy("key", "a", "b").orderBy("order", "doc_id", "size", "mark").rowsBetween(Window.unboundedPreceding, 0)
    return (
        docs.join(cells, ["key", "a", "b"])
        .withColumn(name, (F.col("_before") + F.sum("_v").over(own)).cast("long"))
        .drop("_v", "_before")
    )


def _known(docs: DataFrame, by_source: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``by_source`` (one row a source), by way of the order's buckets.

    A join on the source alone would send all rows of a source to one task; a
    source has at most 65,536 buckets.
    """
    cells = docs.select("key", "a", "b").distinct().join(by_source, "key")
    return docs.join(cells, ["key", "a", "b"])


def chosen(docs: DataFrame, max_epochs: int) -> DataFrame:
    """``sized`` documents with source_size, target and ``copies``, the number of times the mix takes each.

    After the whole passes, documents are picked in order while they fit what is
    left; when most of a source is to be taken, those to leave out are picked.
    """
    targets = written(source_targets(docs, max_epochs), "mix-targets")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    leave = F.col("rest") * 2 > F.col("source_size")
    goals = targets.withColumn("passes", passes).withColumn("rest", rest).withColumn("leave", leave)
    goals = goals.withColumn("goal", F.when(F.col("leave"), F.col("source_size") - F.col("rest")).otherwise(F.col("rest")))
    rows = _known(docs, goals.drop("rest")).withColumn("pick", F.lit(False))
    left = goals.select("key", F.col("goal").alias("_left"))  # one row a source: the words still to pick
    for i in range(FILLS):
        fits = ~F.col("pick") & (F.col("size") > 0) & (F.col("size") <= F.col("_left"))
        rows = running(_known(rows, left), F.when(fits, F.col("size")).otherwise(0), "_run")
        pick = F.col("pick") | (fits & (F.col("_run") <= F.col("_left")))
        rows = written(rows.withColumn("pick", pick).drop("_run", "_left"), f"mix-fill{i}")
        left = rows.groupBy("key").agg((F.max("goal") - F.sum(F.when(F.col("pick"), F.col("size")).otherwise(0))).alias("_left"))
    copies = F.col("passes") + F.when(F.col("pick") != F.col("leave"), 1).otherwise(0)
    return rows.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("long")).drop("pick", "leave", "goal", "passes")


def split(counts: np.ndarray, lo: int, hi: int, seed: int) -> np.ndarray:
    """The left half's block counts at tree node [lo, hi): it gets its shards' share of the blocks, drawn without replacement."""
    total, middle = int(counts.sum()), (lo + hi) // 2
    left = total * (middle - lo) // (hi - lo)
    rng = np.random.default_rng([seed, lo, hi])
    return rng.multivariate_hypergeometric(counts, left, method="marginals")


def quota(counts: np.ndarray, shards: int, shard: int, seed: int, known: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first block, number of blocks) of every source for one shard: the walk from the root to its leaf."""
    known = {} if known is None else known
    lo, hi, first = 0, shards, np.zeros_like(counts)
    while hi - lo > 1:
        if (lo, hi) not in known:
            known[lo, hi] = split(counts, lo, hi, seed)
        left, middle = known[lo, hi], (lo + hi) // 2
        if shard < middle:
            hi, counts = middle, left
        else:
            lo, first, counts = middle, first + left, counts - left
    return first, counts


def _quotas(keys: list[str], counts: list[int], shards: int, seed: int, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n, known = np.array(counts, np.int64), {}
    for frame in frames:
        for shard in frame["id"]:
            if len(known) > 4096:
                known.clear()
            first, many = quota(n, shards, int(shard), seed, known)
            yield pd.DataFrame({"key": keys, "shard": int(shard), "first": first, "many": many})


def draws(picked: DataFrame, shard_words: int, seed: int, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row a draw: doc_id, key, mark, size, end, copy (from 0), shard. ``picked`` as ``placed`` gives it.

    ``end`` names the row within its source: the running count of draws up to it.

    There are as many shards as it takes for ``shard_words`` words in each on average.
    """
    spark = picked.sparkSession
    # a row's draws have neighbouring places in their source's sequence
    ends = F.sequence(F.col("end") - F.col("copies"), F.col("end") - 1)
    places = picked.where("copies > 0").select("doc_id", "key", "mark", "size", "end", F.posexplode(ends).alias("copy", "place"))
    drawn = picked.groupBy("key").agg(F.sum("copies").alias("n"), F.sum(F.col("size") * F.col("copies")).alias("words"))
    found = [r for r in drawn.orderBy("key").collect() if r.n]  # one row a source
    sources = [(r.key, -(-r.n // block_docs)) for r in found]
    shards = max(1, -(-sum(r.words for r in found) // shard_words))
    if not sources:
        return places.select("doc_id", "key", "mark", "size", "end", "copy", F.lit(0).cast("long").alias("shard"))
    # one permutation of each source's blocks: block -> (block * step + seed) mod blocks, step without common factor
    steps = []
    for key, blocks in sources:
        step = max(1, int(blocks * 0.618))
        while gcd(step, blocks) != 1:
            step += 1
        steps.append((key, blocks, step))
    permuted = spark.createDataFrame(steps, "key string, blocks long, step long")
    places = places.join(F.broadcast(permuted), "key").withColumn(  # one row a source
        "slot", (F.floor(F.col("place") / block_docs) * F.col("step") + seed) % F.col("blocks")
    )
    quotas = spark.range(shards).mapInPandas(
        partial(_quotas, [k for k, _ in sources], [n for _, n in sources], shards, seed), "key string, shard long, first long, many long"
    )
    slots = quotas.where("many > 0").select("key", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("many") - 1)).alias("slot"))
    return places.join(slots, ["key", "slot"]).select("doc_id", "key", "mark", "size", "end", "copy", "shard")


def placed(docs: DataFrame, max_epochs: int, seed: int) -> DataFrame:
    """``chosen`` documents with ``end``, the running count of draws over their source's order; written.

    Rows without draws would share the end of the row before them, whole runs of them: they get negative ones
    instead, spread by their order, which no draw has.
    """
    picked = running(chosen(written(sized(docs, seed), "mix-sizes"), max_epochs), F.col("copies"), "end")
    spread = -1 - F.pmod(F.xxhash64("order", "mark"), F.lit(1 << 40))
    return written(picked.withColumn("end", F.when(F.col("copies") > 0, F.col("end")).otherwise(spread)), "mix-places")


def mix_table(docs: DataFrame, max_epochs: int, shard_words: int, seed: int) -> DataFrame:
    """Per document: doc_id, size, source_size, target and taken, the words of the draws that the shards have of its row."""
    picked = placed(docs, max_epochs, seed)
    drawn = draws(picked, shard_words, seed).groupBy("key", "end").agg(F.count("*").alias("_draws"))
    own = F.expr("p.key = d.key AND p.end = d.end")
    taken = F.col("p.size") * F.coalesce("_draws", F.lit(0).cast("long"))
    return picked.alias("p").join(drawn.alias("d"), own, "left").select(
        "p.doc_id", "p.size", "source_size", "target", taken.alias("taken")
    )


def mixed(docs: DataFrame, max_epochs: int, shard_words: int, seed: int) -> DataFrame:
    """The mix itself in the columns of ``docs``: drawn documents, repeats included, each shard together in one file and shuffled."""
    picked = placed(docs, max_epochs, seed)
    drawn = draws(picked, shard_words, seed).select(F.struct("doc_id", "key", "mark", "copy", "shard").alias("draw"))
    # the source's key and the text's hash beside whatever columns the documents have
    key, mark, draw = (free_name(docs, n) for n in ("_key", "_mark", "_draw"))
    texts = docs.withColumns({
        key: F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")), mark: F.xxhash64("text"),
    })
    one = texts.dropDuplicates(["doc_id", key, mark])  # equal rows have their draws together
    same = F.expr(f"doc_id <=> {draw}.doc_id AND {key} = {draw}.key AND {mark} = {draw}.mark")
    joined = one.join(drawn.withColumnRenamed("draw", draw), same)
    shuffled = F.xxhash64(F.lit(seed), f"{draw}.doc_id", f"{draw}.mark", f"{draw}.copy")
    return (
        joined.repartition(F.col(f"{draw}.shard"))
        .sortWithinPartitions(F.col(f"{draw}.shard"), shuffled)
        .select(*docs.columns)
    )
