"""SimHash near-duplicates with pivot distance tables.

1. Each whole text gets a 64-bit SimHash of its word shingles.
2. Equal fingerprints are one class; only distinct fingerprints are compared.
3. Every distinct fingerprint gets a row of Hamming distances to ``PIVOTS``
   reference fingerprints (the pivot table).
4. Two fingerprints within ``max_distance`` bits agree in all but that many of
   ``max_distance + 2`` bit blocks, so they share a bucket of some pair of
   blocks; buckets list candidates without pairing everything with everything.
   Of the bits that a bucket doesn't fix, cut into ``max_distance + 1`` runs, such
   a pair agrees in at least one run as well. So a bucket above ``BUCKET_ROWS``
   fingerprints is dealt into buckets that fix one more run each, and those again,
   as long as that lessens the pairs of the bucket; no pair is lost. What stays
   large is a bucket that no such cut lessens: fingerprints that nearly all lie
   within a few bits of one template, where step 5 reaches most at once.
5. Within a bucket a pair is discarded when any pivot's distances differ by
   more than ``max_distance`` (triangle inequality); survivors are verified by
   the Hamming distance. A bucket returns a spanning forest of its links, at
   most one link a fingerprint, never all pairs.
6. Links are contracted to components by alternating large-star and small-star
   steps; each step is written to the shared folder.

Defined results: a null text counts as empty; a text without words has
fingerprint zero, linked like any other; a text with fewer words than a shingle
is one shingle; repeated rows each get a row; a null id never becomes a
component id unless no member has an id (then null); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import free_name, table_sum, values, written

SEED = 42
PIVOTS = 24
BUCKET_ROWS = 4096
#: Times a large bucket is cut at most; for 3 bits, buckets cut four times leave 11 bits free, so 2048 fingerprints.
CUTS = 4
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str, words_per_shingle: int) -> int:
    """SimHash of lower-cased (A-Z only) shingles, repeats included."""
    words = text.encode().lower().split()  # bytes split at blanks and \t-\r only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(words_per_shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    counts = np.zeros(64, np.int64)
    for a in range(0, n, HASHES_AT_ONCE):
        b = min(n, a + HASHES_AT_ONCE)
        spans = zip(starts[a:b].tolist(), ends[a + k - 1 : b + k - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t or "", words) for t in values(batch.column(1))], np.uint64)
        others = [i for i in range(batch.num_columns) if i != 1]  # all but the text
        names = [batch.schema.names[i] for i in others]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in others), pa.array(prints.view(np.int64))], [*names, "fp"])


def fingerprints(docs: DataFrame, words_per_shingle: int) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(partial(_fingerprint_batches, words_per_shingle), f"doc_id {kind}, fp long")


def block_masks(max_distance: int) -> list[int]:
    """One 64-bit mask for each pair of ``max_distance + 2`` bit blocks."""
    cuts = np.linspace(0, 64, max_distance + 3).round().astype(int).tolist()
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [x | y for x, y in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _pivot_batches(pivots: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    refs = np.array(pivots, np.int64)
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        rows = np.bitwise_count((fps[:, None] ^ refs[None, :]).view(np.uint64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["fp", "pivots"]
        )


def forest(fps: np.ndarray, pivots: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Links that join all fingerprints of a bucket within ``max_distance``, at most one a fingerprint.

    Breadth-first over the fingerprints not reached yet, so a dense group
    shrinks at once instead of being compared pair by pair.
    """
    links = []
    left = np.arange(len(fps))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = left
            for j in range(0, pivots.shape[1], 8):
                gap = np.abs(pivots[near, j : j + 8].astype(np.int16) - pivots[at, j : j + 8].astype(np.int16))
                near = near[(gap <= max_distance).all(axis=1)]
                if not len(near):
                    break
            if len(near):
                near = near[np.bitwise_count((fps[near] ^ fps[at]).view(np.uint64)) <= max_distance]
            if len(near):
                links.extend((int(fps[at]), int(fps[x])) for x in near)
                queue.extend(near)
                left = np.setdiff1d(left, near, assume_unique=True)
    return links


def _link_batches(max_distance: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets arrive in order of (key columns, fp); the last one of a batch may go on in the next."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def solved(keys, fps, pivots):
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = np.concatenate([[0], edges, [len(fps)]])
        links = []
        for i in np.flatnonzero(np.diff(bounds) > 1):
            a, b = bounds[i], bounds[i + 1]
            links += forest(fps[a:b], pivots[a:b], max_distance)
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["u", "v"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)], axis=1)
        fps = batch.column(2).to_numpy(zero_copy_only=False)
        pivots = np.frombuffer(b"".join(values(batch.column(3))), np.uint8).reshape(len(fps), -1)
        if held and (held[-1][0][-1] != keys[0]).any():
            yield solved(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held = []
        # rows before the last bucket are complete
        same = (keys == keys[-1]).all(axis=1)
        start = 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1
        if start:
            parts = [*held, (keys[:start], fps[:start], pivots[:start])]
            yield solved(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            held = []
        held.append((keys[start:].copy(), fps[start:].copy(), pivots[start:].copy()))
    if held:
        yield solved(*(np.concatenate(x) for x in zip(*held, strict=True)))


def cut_masks(mask: int, max_distance: int) -> list[int]:
    """``mask`` with each of ``max_distance + 1`` runs of its free bits; none where no more bits are free than may differ."""
    free = [b for b in range(64) if not mask >> b & 1]
    if len(free) <= max_distance:
        return []
    return [mask | sum(1 << int(b) for b in run) for run in np.array_split(free, max_distance + 1)]


def buckets(with_pivots: DataFrame, max_distance: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(mask, key, fp, pivots): every two fingerprints within ``max_distance`` share some bucket (mask, key).

    Above ``bucket_rows`` rows are only buckets that no cut lessens. The loop ends after
    ``CUTS`` levels; the driver sees whether large buckets are left, and the masks (at most 2560 for 3 bits).
    """
    spark = with_pivots.sparkSession
    masks = block_masks(max_distance)
    level = with_pivots.select("fp", "pivots", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask")).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp", "pivots"
    )
    finished = []
    for _ in range(CUTS):
        sizes = level.groupBy("mask", "key").agg(F.count("*").alias("many"))
        large = written(sizes.where(F.col("many") > bucket_rows), "large-buckets")
        if large.isEmpty():
            break
        cuts = [(m, cut_masks(m, max_distance)) for m in masks]
        masks = sorted({c for _, found in cuts for c in found})
        offered = spark.createDataFrame(
            [(_signed(m), _signed(c)) for m, found in cuts for c in found], "mask long, cut long"
        )
        cut_rows = written(
            level.join(large, ["mask", "key"])
            .join(F.broadcast(offered), "mask")
            .select("mask", "key", "many", "cut", F.col("fp").bitwiseAND(F.col("cut")).alias("cut_key"), "fp", "pivots"),
            "cut-buckets",
        )
        parts = cut_rows.groupBy("mask", "key", "many", "cut", "cut_key").agg(F.count("*").cast("decimal(19,0)").alias("n"))
        pairs = parts.groupBy("mask", "key", "many").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
        whole = F.col("many").cast("decimal(19,0)")
        lessened = written(pairs.where(F.col("pairs") < whole * whole).select("mask", "key"), "lessened-buckets")
        # neither small nor lessened by a cut: stays as it is
        stays = level.join(large.join(lessened, ["mask", "key"], "left_anti").select("mask", "key"), ["mask", "key"], "left_semi")
        finished += [level.join(large.select("mask", "key"), ["mask", "key"], "left_anti"), stays]
        level = cut_rows.join(lessened, ["mask", "key"], "left_semi").select(
            F.col("cut").alias("mask"), F.col("cut_key").alias("key"), "fp", "pivots"
        )
    for rows in finished:
        level = level.unionByName(rows)
    return level


def links(distinct: DataFrame, max_distance: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(u, v) links whose components are those of all pairs of ``distinct`` (column fp) within ``max_distance``."""
    spark = distinct.sparkSession
    refs = [r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(PIVOTS).collect()] or [0]
    with_pivots = distinct.select("fp").mapInArrow(partial(_pivot_batches, refs), "fp long, pivots binary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    arranged = buckets(with_pivots, max_distance, bucket_rows).repartition(n, "mask", "key").sortWithinPartitions("mask", "key", "fp")
    return arranged.mapInArrow(partial(_link_batches, max_distance), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component; nodes without links don't appear."""
    edges = written(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    state = table_sum(edges, "u", "v")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = written(small, "links")
        before, state = state, table_sum(edges, "u", "v")
        if before == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _placed(prints: DataFrame, first, max_distance: int) -> DataFrame:
    """(fp, root, least): each distinct fingerprint, its component's root and the least ``first`` of its rows."""
    classes = written(prints.groupBy("fp").agg(F.min(first).alias("least")), "classes")
    roots = components(links(classes, max_distance))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, words_per_shingle: int, max_distance: int) -> DataFrame:
    """(doc_id, fp, component_id): the smallest id reachable over links of at most ``max_distance`` bits."""
    prints = written(fingerprints(docs, words_per_shingle), "fingerprints")
    placed = _placed(prints, F.col("doc_id"), max_distance)
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, words_per_shingle: int, max_distance: int) -> DataFrame:
    """One row of each component, in the columns of ``docs``: the least by id (null ids last), text hash and row hash.

    The staying row is found again by its id and both hashes, so texts that
    share an id are kept apart; of wholly equal rows, one stays.
    """
    mark, row = free_name(docs, "_mark"), free_name(docs, "_row")
    plain = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]  # maps have no hash
    marked = docs.withColumns({mark: F.xxhash64("text"), row: F.xxhash64(*plain)})
    kind = docs.schema["doc_id"].dataType.simpleString()
    prints = written(
        marked.select("doc_id", "text", F.col(mark).alias("mark"), F.col(row).alias("row")).mapInArrow(
            partial(_fingerprint_batches, words_per_shingle), f"doc_id {kind}, mark long, row long, fp long"
        ),
        "fingerprints",
    )
    first = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "mark", "row")
    stay = _placed(prints, first, max_distance).groupBy("root").agg(F.min("least").alias("least"))
    stay = stay.select(*(F.col(f"least.{c}").alias(f"_stay_{c}") for c in ("doc_id", "mark", "row")))
    same = F.col("doc_id").eqNullSafe(F.col("_stay_doc_id")) & (F.col(mark) == F.col("_stay_mark")) & (F.col(row) == F.col("_stay_row"))
    kept = marked.join(stay, same, "left_semi").dropDuplicates(["doc_id", mark, row])
    return kept.select(*docs.columns)
