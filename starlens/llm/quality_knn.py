"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A document's terms are its hashed words, the hashed shapes of its words
(``Aa,`` for ``The,``, over the whole word however long) and a few bucketed ratios (repeated words, repeated
lines, ...). Term counts are damped, weighted by inverse document frequency
and projected on the leading singular vectors of a bounded labelled sample.
The labelled vectors are broadcast (their number is a parameter), each block of
documents takes its exact cosine products with all of them, and the labels of
the nearest ``neighbours`` vote with weights that grow with similarity.

Only texts enter a score. The sample is at most ``per_class`` documents of each
class among the usable labels.

Defined results: a null text counts as empty; a text without words has the terms
"no words" only and is scored like any other; without any usable label every
score is 0.5; with labels of one class the score is that class; repeated rows
get equal scores; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from starlens.llm.common import labelled_sample, values

WORDS, SHAPES, BUCKETS, RATIOS = 4096, 512, 11, 5
DIMENSIONS = WORDS + SHAPES + BUCKETS * RATIOS
#: Share of each group of terms in a vector's squared length.
GROUP_WEIGHTS = ((0, WORDS, 0.2), (WORDS, WORDS + SHAPES, 0.4), (WORDS + SHAPES, DIMENSIONS, 0.4))
RANK = 64
NEIGHBOURS = 25
SHARPNESS = 4
PER_CLASS = 1500
BLOCK = 256
CACHE_ENTRIES = 200_000
_RUN = re.compile(r"(.)\1+")
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def shape(chunk: str) -> str:
    """Character classes of the whole chunk, equal neighbours merged: ``The,`` -> ``Aa,``."""
    kinds = "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in chunk)
    return _RUN.sub(r"\1", kinds)


class _Terms(dict):
    """chunk -> hashed word and hashed shape, packed; emptied when full."""

    def __missing__(self, chunk: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        word = crc32(_EDGE.sub("", chunk.lower()).encode()) % WORDS
        packed = word * SHAPES + crc32(shape(chunk).encode()) % SHAPES
        if len(chunk) <= 64:
            self[chunk] = packed
        return packed


_TERMS = _Terms()


def _bucket(out: np.ndarray, group: int, x: float) -> None:
    """Spread a ratio in [0, 1] over its two nearest buckets."""
    at = WORDS + SHAPES + group * BUCKETS
    low = min(int(x * (BUCKETS - 1)), BUCKETS - 2)
    part = x * (BUCKETS - 1) - low
    out[at + low] += 1 - part
    out[at + low + 1] += part


def term_counts(text: str) -> np.ndarray:
    """The document's term counts (damped) and ratio buckets, before idf."""
    out = np.zeros(DIMENSIONS, np.float32)
    chunks = text.split()
    if not chunks:
        out[-1] = 1
        return out
    packed = np.fromiter(map(_TERMS.__getitem__, chunks), np.int64, len(chunks))
    out[:WORDS] = np.log1p(np.bincount(packed // SHAPES, minlength=WORDS))
    out[WORDS : WORDS + SHAPES] = np.log1p(np.bincount(packed % SHAPES, minlength=SHAPES))
    lines = text.split("\n")
    _bucket(out, 0, len(np.unique(packed)) / len(packed))
    _bucket(out, 1, float(np.mean(packed[1:] == packed[:-1])) if len(packed) > 1 else 0.0)
    _bucket(out, 2, len(set(lines)) / len(lines))
    _bucket(out, 3, min(1.0, (len(text) / len(chunks)) / 20))
    _bucket(out, 4, min(1.0, np.log1p(len(chunks)) / 10) * 0.9)
    return out


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf
    for a, b, share in GROUP_WEIGHTS:
        norm = np.linalg.norm(x[:, a:b], axis=1, keepdims=True)
        x[:, a:b] *= np.sqrt(share) / np.maximum(norm, 1e-9)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class LatentNeighbours:
    """The fitted space: idf, projection, labelled unit vectors and their labels."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, rank: int = RANK, neighbours: int = NEIGHBOURS):
        n = len(counts)
        self.neighbours = min(neighbours, n)
        self.labels = labels.astype(np.float32)
        self.idf = (np.log((1 + n) / (1 + (counts > 0).sum(axis=0))) + 0.1).astype(np.float32)
        x = _weighted(counts, self.idf)
        # randomised range finder with power steps, then an exact SVD of the small factor
        rank = min(rank, *x.shape)
        q = np.random.default_rng(7).standard_normal((x.shape[1], min(rank + 16, *x.shape))).astype(np.float32)
        for _ in range(4):
            q, _ = np.linalg.qr(x.T @ (x @ q))
        _, _, v = np.linalg.svd(x @ q, full_matrices=False)
        self.projection = (q @ v[:rank].T).astype(np.float64)
        self.vectors = _unit(x.astype(np.float64) @ self.projection)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        latent = _unit(_weighted(counts, self.idf).astype(np.float64) @ self.projection)
        # The last bits of a product depend on the block it is computed in. Without them equal texts score
        # the same; ties go to the earlier vector.
        cosine = np.round(latent @ self.vectors.T, 9)
        cosine -= np.arange(cosine.shape[1]) * 1e-13
        near = np.sort(np.argpartition(-cosine, self.neighbours - 1, axis=1)[:, : self.neighbours], axis=1)
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-3) ** SHARPNESS
        return np.clip((weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1), 0.0, 1.0)


def _sparse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, x = [], []
        for text in values(batch.column(0)):
            counts = term_counts(text or "")
            used = np.flatnonzero(counts).astype(np.uint16)
            at.append(used.tobytes())
            x.append(counts[used].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(at, pa.binary()), pa.array(x, pa.binary())], ["label", "at", "x"]
        )


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, per_class: int = PER_CLASS):
    """Fit on at most ``2 * per_class`` labelled documents (``labels``: doc_id, quality); None without labels.

    ``usable`` filters labels by their id, column ``_id``. The driver gets the
    sample's sparse term counts, a few kB a document.
    """
    sample = labelled_sample(docs, labels, "quality", per_class, usable)
    rows = (
        sample.select("text", "label")
        .mapInArrow(_sparse_batches, "label int, at binary, x binary")
        .collect()
    )
    if not rows:
        return None
    rows.sort(key=lambda r: (r.label, bytes(r.at), bytes(r.x)))
    counts = np.zeros((len(rows), DIMENSIONS), np.float32)
    for i, r in enumerate(rows):
        counts[i, np.frombuffer(r.at, np.uint16)] = np.frombuffer(r.x, np.float32)
    return LatentNeighbours(counts, np.array([r.label for r in rows]))


def _score_batches(model, name: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fitted = model.value
    for batch in batches:
        scores = np.full(batch.num_rows, 0.5)
        for a in range(0, batch.num_rows, BLOCK) if fitted is not None else ():
            texts = [t or "" for t in values(batch.column(0).slice(a, BLOCK))]
            scores[a : a + BLOCK] = fitted.scores(np.stack([term_counts(t) for t in texts]))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])


def quality_scores(docs: DataFrame, model, name: str = "score") -> DataFrame:
    """``docs`` with its score in a new column ``name``; ``docs`` must have its text in the first column."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(partial(_score_batches, shared, name), f"{fields}, `{name}` double")
