"""Exact top-k inner products by best-first search in M-trees.

Vectors become integers (floor(scale * x)). With the Euclidean metric, a node of
routing vector c and covering radius r holds only vectors whose inner product
with a query q is at most q.c + |q| r; and q.c itself is at most q.p + |q| d(p, c)
for the routing vector p of the node's parent. So a stored parent distance
decides without computing q.c, and only nodes that survive it have theirs
computed.

The forest: routing vectors drawn from the table (a bounded sample) cut it into
clusters by nearest routing vector; large clusters are dealt over several
partitions, so a vector that a third of the rows share is no single task. Each
partition is bulk-loaded into a paged M-tree of its own: leaf pages of
``page`` vectors, inner nodes of up to 8 children, each with its covering
radius and its distance from its parent.

The search runs in two rounds. First every query searches one tree of each of its
nearest clusters, which gives a score that the k-th best at least has. Then the pairs
(query, tree) whose root bound reaches that score are formed from the directory
of roots, and each tree is searched best-first by its queries with that score as
the start. Both rounds return at most k rows a pair; ties at the limit are kept.

Defined results: vectors that are null, or hold a null or non-finite component,
or whose length differs from most vectors' (the most frequent one, the longer on
ties) take no part; null ids take no part; rows that repeat an id are candidates
each, but none for a query of that id, and are one query together; products are exact
at any size, and a component or score beyond a 64-bit integer is an error that names its rows; ties go to the smaller id; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.llm.common import values, written

#: Routing vectors are chosen among the rows of least id hash: at least so many, and four for each cluster.
SAMPLE = 256
#: Vectors a tree should hold; the number of clusters follows from it, up to ``CLUSTERS``.
TREE_ROWS = 4096
CLUSTERS = 2048
PAGE = 64
#: Clusters that the first round searches for each query.
FIRST = 2
#: Queries that one task holds at once.
QUERY_BLOCK = 20_000
BLOCK = 512


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every vector that takes part, as longs."""
    clean = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("x")).where(
        "id IS NOT NULL AND x IS NOT NULL AND size(x) > 0"
        " AND forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))"
    )
    # the smallest id is named, whichever task would meet its vector first
    beyond = F.min(F.when(F.exists("x", lambda c: F.abs(c * float(scale)) >= 2.0**63), F.col("id"))).alias("beyond")
    lengths = clean.groupBy(F.size("x").alias("n")).agg(F.count("*").alias("many"), beyond).orderBy(F.desc("many"), F.desc("n")).limit(1)
    usual = lengths.first()
    width = usual.n if usual else 0
    if usual and usual.beyond is not None:
        raise ValueError(f"a component of vector {usual.beyond} is beyond a long")
    whole = F.transform("x", lambda c: F.floor(c * float(scale)))
    return clean.where(F.size("x") == width).select("id", whole.alias("v"))


def _integers(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _matrix(column: pa.Array) -> np.ndarray:
    return _integers(column).astype(np.float64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, to choose clusters by; bounds are taken from differences instead."""
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _nearest_batches(routing, many: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, v) -> (id, v, cluster) for each vector's ``many`` nearest routing vectors."""
    centres = routing.value
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK):
            part = batch.slice(a, BLOCK)
            d = _distances(_matrix(part.column(1)), centres)
            near = np.argsort(d, axis=1, kind="stable")[:, :many]
            rows = pa.array(np.repeat(np.arange(part.num_rows), near.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(rows), part.column(1).take(rows), pa.array(near.ravel().astype(np.int32))], ["id", "v", "cluster"]
            )


def _slack(norm, longest):
    """What rounding may take from a bound on products of a query and vectors of these lengths."""
    return (1e-6 + 1e-12 * longest) * (1 + norm)


class Node:
    """Routing vector (a row number), covering radius, distance from the parent's, and children or rows."""

    __slots__ = ("children", "parent_distance", "radius", "routing", "rows")

    def __init__(self, routing, radius, children=None, rows=None):
        self.routing, self.radius, self.children, self.rows, self.parent_distance = routing, radius, children, rows, 0.0


class MTree:
    """A paged M-tree over the rows of one partition, bulk-loaded by halving along far-apart pivots."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, page: int = PAGE):
        self.ids, self.integers, self.x, self.page = ids, x, x.astype(np.float64), page
        self.longest = float(np.sqrt((self.x**2).sum(axis=1)).max(initial=0))
        self.computed = 0
        self.root = self._load(np.arange(len(ids)))

    def _to(self, row: int, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.x[rows] - self.x[row]) ** 2).sum(axis=1))

    def _median(self, rows: np.ndarray) -> int:
        """The row nearest the rows' mean: a routing vector with a small radius."""
        mean = self.x[rows].mean(axis=0)
        return int(rows[np.argmin(((self.x[rows] - mean) ** 2).sum(axis=1))])

    def _load(self, rows: np.ndarray) -> Node:
        routing = self._median(rows)
        distance = self._to(routing, rows)
        if len(rows) <= self.page:
            order = np.lexsort((self.ids[rows], distance))
            node = Node(routing, float(distance.max()), rows=rows[order])
            node.children = distance[order]  # a leaf keeps its entries' distances from its routing vector
            return node
        parts = [rows]
        while len(parts) < 8:
            parts.sort(key=len)
            widest = parts.pop()
            if len(widest) <= self.page:
                parts.append(widest)
                break
            far = widest[np.argmax(self._to(int(widest[0]), widest))]
            other = widest[np.argmax(self._to(int(far), widest))]
            side = self._to(int(far), widest) - self._to(int(other), widest)
            order = np.argsort(side, kind="stable")  # equal vectors are split by number, so pages stay full
            half = len(order) // 2
            parts += [widest[order[:half]], widest[order[half:]]]
        node = Node(routing, float(distance.max()), children=[self._load(p) for p in parts])
        for child in node.children:
            child.parent_distance = float(self._to(routing, np.array([child.routing]))[0])
        return node

    def _scores(self, rows: np.ndarray, q: np.ndarray, norm: float) -> list[int]:
        """Exact inner products. |x| |q| bounds every partial sum: doubles are exact below 2^53, longs below 2^63."""
        most = norm * self.longest
        if most < 2.0**52:
            return (self.x[rows] @ q.astype(np.float64)).astype(np.int64).tolist()
        if most < 2.0**62:
            return (self.integers[rows].astype(np.int64) @ q.astype(np.int64)).tolist()
        query = [int(c) for c in q.tolist()]
        return [sum(int(a) * b for a, b in zip(row, query, strict=True)) for row in self.integers[rows].tolist()]

    def search(self, integers: np.ndarray, own: int, k: int, least: float) -> list[tuple[int, int]]:
        """(score, id) of the k best rows scoring at least ``least``, best-first; row ids equal to ``own`` don't count."""
        q = integers.astype(np.float64)
        norm = float(np.sqrt((q * q).sum()))
        slack = _slack(norm, self.longest)  # bounds are floating point, scores exact
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        at_root = float(q @ self.x[self.root.routing])
        queue = [(-(at_root + norm * self.root.radius), 0, at_root, self.root)]
        made = 1
        while queue:
            bound, _, product, node = heapq.heappop(queue)
            if -bound + slack < least:
                break
            if node.rows is not None:
                # entries by distance from the routing vector: q.x <= product + |q| d
                reach = np.searchsorted(node.children, (least - slack - product) / norm if norm else -1.0)
                rows = node.rows[reach:] if norm else node.rows
                self.computed += len(rows)
                scores = self._scores(rows, integers, norm)
                for score, i in zip(scores, self.ids[rows].tolist(), strict=True):
                    if i == own or score < least:
                        continue
                    entry = (score, -i)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                    if len(best) == k:
                        least = max(least, best[0][0])
                continue
            for child in node.children:
                if product + norm * (child.parent_distance + child.radius) + slack < least:
                    continue  # decided by the stored distance alone
                inner = float(q @ self.x[child.routing])
                self.computed += 1
                top = inner + norm * child.radius
                if top + slack >= least:
                    heapq.heappush(queue, (-top, made, inner, child))
                    made += 1
        return [(score, -i) for score, i in sorted(best, key=lambda e: (-e[0], -e[1]))]


def _search_group(k: int, key, left: pa.Table, right: pa.Table) -> pa.Table:
    """One tree's vectors and the queries sent to it -> each query's k best."""
    out = {"query_id": [], "id": [], "score": []}
    if left.num_rows and right.num_rows:
        tree = MTree(left.column("id").to_numpy(), _integers(left.column("v")))
        queries, own = _integers(right.column("v")), right.column("id").to_pylist()
        for q, i, least in zip(queries, own, right.column("least").to_pylist(), strict=True):
            for score, found in tree.search(q, i, k, -np.inf if least is None else least):
                if not -(2**63) <= score < 2**63:
                    raise ValueError(f"the product of vectors {i} and {found} is beyond a long: {score}")
                out["query_id"].append(i)
                out["id"].append(found)
                out["score"].append(score)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in out.items()})


def _best(found: DataFrame, k: int) -> DataFrame:
    """Each query's k best rows."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest integer inner products with other rows.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    rows = written(integer_vectors(vectors, scale), "vectors")
    count = rows.count()
    wanted = max(1, min(CLUSTERS, count // TREE_ROWS))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(max(SAMPLE, 4 * wanted)).collect()
    clusters = max(1, min(wanted, len(sample)))
    routing = _far_apart(np.array([r.v for r in sample], np.float64), clusters) if sample else np.zeros((1, 1))
    shared = spark.sparkContext.broadcast(routing)
    shape = "id long, v array<long>, cluster int"
    placed = rows.mapInArrow(partial(_nearest_batches, shared, 1), shape)
    sizes = {r.cluster: r["count"] for r in placed.groupBy("cluster").count().collect()}  # at most CLUSTERS rows
    parts = {c: max(1, round(n / TREE_ROWS)) for c, n in sizes.items()}
    by_cluster = F.element_at(F.create_map(*[F.lit(x) for c in sorted(parts) for x in (c, parts[c])]), F.col("cluster")) if parts else F.lit(1)
    trees = written(
        placed.withColumn("part", (F.pmod(F.xxhash64("id", "v"), by_cluster)).cast("int")), "trees"
    )
    queries = written(rows.where(is_query).distinct(), "queries")
    result = "query_id long, id long, score long"
    search = partial(_search_group, k)

    # round one: one tree of each of a query's nearest clusters
    near = queries.mapInArrow(partial(_nearest_batches, shared, FIRST), shape)
    one = F.pmod(F.xxhash64("id"), by_cluster).cast("int").alias("part")
    # a tree meets its queries in blocks of bounded size, each with its own copy of the tree
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    copies = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    every = F.explode(F.sequence(F.lit(0), by_cluster - 1)).alias("part")
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    keys = ["cluster", "part", "block"]
    sent = near.select("id", "v", "cluster", one, block).withColumn("least", F.lit(None).cast("long"))
    first = written(copies.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(search, result), "first")
    least = _best(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))

    # round two: trees whose root bound reaches a query's k-th score so far
    radii = placed.mapInArrow(partial(_radius_batches, shared), "cluster int, radius double").groupBy("cluster").agg(F.max("radius"))
    reach = np.full(len(routing), -1.0)
    for cluster, radius in radii.collect():  # at most CLUSTERS rows
        reach[cluster] = radius
    limits = spark.sparkContext.broadcast(reach)
    known = queries.join(least, "id", "left").select("id", "v", "least")
    reached = known.mapInArrow(partial(_reached_batches, shared, limits), "id long, v array<long>, least long, cluster int")
    searched = near.select("id", "cluster", one).distinct()
    again = reached.select("id", "v", "cluster", every, block, "least").join(searched, ["id", "cluster", "part"], "left_anti")
    second = copies.groupBy(*keys).cogroup(again.groupBy(*keys)).applyInArrow(search, result)
    both = first.unionByName(second)
    return _best(both, k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def _far_apart(sample: np.ndarray, many: int) -> np.ndarray:
    """``many`` distinct rows of the sample, each the farthest from those before."""
    chosen = [0]
    distance = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < many:
        at = int(np.argmax(distance))
        if distance[at] <= 0:
            break
        chosen.append(at)
        distance = np.minimum(distance, _distances(sample, sample[at : at + 1])[:, 0])
    return sample[chosen]


def _radius_batches(routing, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, v, cluster) -> the covering radius of each cluster in the batch."""
    centres = routing.value
    for batch in batches:
        if not batch.num_rows:
            continue
        x, cluster = _matrix(batch.column(1)), batch.column(2).to_numpy()
        d = np.sqrt(((x - centres[cluster]) ** 2).sum(axis=1))
        seen, back = np.unique(cluster, return_inverse=True)
        most = np.zeros(len(seen))
        np.maximum.at(most, back, d)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(most)], ["cluster", "radius"])


def _reached_batches(routing, limits, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, v, least) -> a row for each cluster that may hold a score of at least ``least``."""
    centres, radius = routing.value, limits.value
    longest = float(np.sqrt((centres**2).sum(axis=1)).max() + radius.max())
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK):
            part = batch.slice(a, BLOCK)
            q = _matrix(part.column(1))
            if not len(q):
                continue
            least = np.array([-np.inf if x is None else x for x in values(part.column(2))])
            norm = np.sqrt((q * q).sum(axis=1))[:, None]
            bound = q @ centres.T + norm * radius[None, :] + _slack(norm, longest)
            row, cluster = np.nonzero((bound >= least[:, None]) & (radius >= 0)[None, :])
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(take), part.column(1).take(take), part.column(2).take(take), pa.array(cluster.astype(np.int32))],
                ["id", "v", "least", "cluster"],
            )
