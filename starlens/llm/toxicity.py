"""Toxicity scores by a counterfactual-regularised linear classifier.

Features are the words of a document and the five-letter beginnings of longer
words, present or not. The vocabulary holds the features that separate the
classes best among a bounded labelled sample, plus every identity term. Weights
minimise the logistic loss of the sample, an L1 penalty, and a counterfactual
penalty: in each labelled sentence that names a group, the term is swapped for
each other term of its kind, and the squared change that this makes to its
document's score is added. Features say whether a word is present, so a term that
another sentence names too does not go, and one that the document names already does
not come; a swap that changes no feature adds nothing. So a mention of a group can't raise a score by itself, whichever group
it is and however often toxic documents name it.

Only texts enter a score. Defined results: a null text counts as empty; an empty
text scores the intercept, which is moved to the labels' true class shares; without usable labels every
score is 0.5; repeated rows get equal scores; an empty table gives an empty
result; other columns are ignored. Whole texts are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import labelled_sample, values, written

#: Fixed word lists: terms of one kind may stand for each other in a sentence.
IDENTITY_TERMS = {
    "gender": "women men woman man girls boys female male people person",
    "religion": "muslims christians jews hindus buddhists atheists muslim christian jewish hindu buddhist people person",
    "origin": "immigrants refugees foreigners africans asians europeans mexicans arabs african asian european mexican arab people person",
    "colour": "black white brown people person",
    "orientation": "gay lesbian straight bisexual transgender queer people person",
    "ability": "disabled blind deaf autistic people person",
    "gender_de": "frauen männer frau mann menschen leute",
    "religion_de": "muslime christen juden menschen leute",
    "gender_fr": "femmes hommes femme homme gens personnes",
    "religion_fr": "musulmans chrétiens juifs gens personnes",
    "gender_es": "mujeres hombres mujer hombre gente personas",
    "religion_es": "musulmanes cristianos judíos gente personas",
}
KINDS = {kind: terms.split() for kind, terms in IDENTITY_TERMS.items()}
IDENTITY = sorted({t for terms in KINDS.values() for t in terms})
PER_CLASS = 2000
VOCABULARY = 20_000
PREFIX = 5
STEPS = 200
COUNTERFACTUAL = 0.5
CACHE_ENTRIES = 200_000
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def word_features(word: str) -> list[str]:
    """A lower-case word and, of a longer one that names no group, its beginning."""
    return [word, word[:PREFIX] + "-"] if len(word) > PREFIX and word not in _IDENTITY_SET else [word]


_IDENTITY_SET = frozenset(IDENTITY)


def features(text: str) -> set[str]:
    return {f for w in set(_WORD.findall(text.lower())) for f in word_features(w)}


def swaps(text: str) -> list[tuple[str, str]]:
    """For each sentence, each identity term in it and each other term of its kind: the term that goes from the
    document's features and the one that comes, '' where none does; swaps that change nothing are left out."""
    sentences = [set(_WORD.findall(s)) for s in _SENTENCE.split(text.lower())]
    many = Counter(t for s in sentences for t in s & _IDENTITY_SET)
    out = []
    for sentence in sentences:
        for term in sorted(sentence & _IDENTITY_SET):
            gone = term if many[term] == 1 else ""
            for other in sorted({o for kind in KINDS.values() if term in kind for o in kind} - {term}):
                come = "" if many[other] else other
                if gone or come:
                    out.append((gone, come))
    return out


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, label, feature) rows, and a feature ``=gone>come`` for each swap of a term in a sentence."""
    for batch in batches:
        for key, text, label in zip(*(batch.column(i) for i in range(3)), strict=True):
            text = text.as_py() or ""
            found = sorted(features(text))
            named = [] if _IDENTITY_SET.isdisjoint(found) else [f"={gone}>{come}" for gone, come in swaps(text)]
            n = len(found) + len(named)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key.as_py()] * n, pa.int64()), pa.array([label.as_py()] * n, pa.int32()), pa.array(found + named, pa.string())],
                ["_id", "label", "feature"],
            )


class ToxicityModel:
    """Weights by feature, and an intercept."""

    def __init__(self, weights: dict[str, float], intercept: float):
        self.weights, self.intercept = weights, intercept

    def score(self, text: str) -> float:
        margin = self.intercept + sum(self.weights.get(f, 0.0) for f in features(text))
        return 1 / (1 + np.exp(-margin))


def train(
    rows: np.ndarray, cols: np.ndarray, labels: np.ndarray, names: list[str], pairs, prior: float,
    strength: float = COUNTERFACTUAL, steps: int = STEPS,
) -> ToxicityModel:
    """FISTA on the mean logistic loss + L1 + ``strength`` * mean squared score change of the swaps.
    rows, cols: the sample's (document, feature) incidences; pairs: (term that goes, term that comes, number of swaps).
    """
    n, d = len(labels), len(names)
    at = {name: i for i, name in enumerate(names)} | {"": d}  # no term: a feature whose weight stays 0
    a = np.array([at[x] for x, _, _ in pairs], np.int64)
    b = np.array([at[x] for _, x, _ in pairs], np.int64)
    many = np.array([k for _, _, k in pairs], np.float64)
    many = many / many.sum() if len(many) else many
    # Lipschitz bound of the gradient: power iteration on X'X / 4n, the swaps' part, and room for the intercept
    v = np.random.default_rng(3).standard_normal(d)
    top = 1.0
    for _ in range(12):
        v = np.bincount(cols, np.bincount(rows, v[cols], minlength=n)[rows], minlength=d)
        top = float(np.linalg.norm(v)) or 1.0
        v = v / top
    rate = 1 / (0.25 * top / n * 1.2 + 4 * strength + 0.25)
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    w, bias = np.zeros(d), 0.0
    # the L1 pass selects features; the second pass frees the chosen ones of the L1 shrinkage
    for l1, l2 in (((0.5 + 0.0015 * n) / n, 0.0), (0.0, 1.0 / n)):
        kept = np.ones(d) if l1 else w != 0
        z, zb, t = w.copy(), bias, 1.0
        for _ in range(steps):
            margin = np.bincount(rows, z[cols], minlength=n) + zb
            residual = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / n
            gradient = np.bincount(cols, residual[rows], minlength=d) + l2 * z
            if len(many):
                padded = np.append(z, 0.0)
                change = 2 * strength * many * (padded[a] - padded[b])
                gradient += (np.bincount(a, change, minlength=d + 1) - np.bincount(b, change, minlength=d + 1))[:d]
            new = (z - rate * gradient) * kept
            new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
            new_bias = zb - rate * residual.sum()
            t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
            z, zb = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
            w, bias, t = new, new_bias, t_new
    # the classes weighed the same in training; the intercept moves to their true shares
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    return ToxicityModel({names[i]: float(w[i]) for i in np.flatnonzero(w)}, float(bias + np.log(prior / (1 - prior))))


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None,
    per_class: int = PER_CLASS, vocabulary: int = VOCABULARY,
) -> ToxicityModel | None:
    """Fit on at most ``2 * per_class`` labelled documents (``labels``: doc_id, toxic); None without labels.

    Feature counts are Spark aggregates; the driver gets ``vocabulary`` names
    and the sample's incidences with them.
    """
    sample = labelled_sample(docs, labels, "toxic", per_class, usable).withColumn("_id", F.xxhash64("_id"))
    pairs = written(sample.mapInArrow(_feature_batches, "_id long, label int, feature string"), "toxicity-sample")
    sizes = dict(pairs.groupBy("label").agg(F.countDistinct("_id")).collect())
    total = sum(sizes.values())
    if not total:
        return None
    known = labels.select(F.col("doc_id").alias("_id"), "toxic").where(F.col("_id").isNotNull() & F.col("toxic").isin(0, 1))
    prior = (known if usable is None else known.where(usable)).agg(F.avg("toxic")).first()[0]
    if len(sizes) < 2:
        return ToxicityModel({}, 20.0 if 1 in sizes else -20.0)
    n1, n0 = float(sizes[1]), float(sizes[0])
    counted = (
        pairs.groupBy("feature")
        .agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q"))
        .withColumn("named", F.col("feature").startswith("="))
    )
    # at most a row for each two identity terms
    swapped = [(*r.feature[1:].split(">"), int(r.p + r.q)) for r in counted.where("named").orderBy("feature").collect()]
    chance = (F.col("p") + F.col("q")) / F.lit(total)
    contrast = F.abs(F.col("p") / n1 - F.col("q") / n0) / F.sqrt(chance * (1.0001 - chance) * (1 / n1 + 1 / n0))
    chosen = counted.where(~F.col("named") & (F.col("p") + F.col("q") >= 2)).orderBy(contrast.desc(), "feature")
    names = [r.feature for r in chosen.limit(vocabulary).select("feature").collect()]
    names = list(dict.fromkeys([*names, *IDENTITY]))
    index = docs.sparkSession.createDataFrame(list(enumerate(names)), "at int, feature string")
    hits = pairs.join(F.broadcast(index), "feature").groupBy("_id", "label").agg(F.sort_array(F.collect_set("at")).alias("at"))
    found = hits.orderBy("_id").collect()
    rows = np.repeat(np.arange(len(found)), [len(r["at"]) for r in found])
    cols = np.concatenate([np.array(r["at"], np.int64) for r in found]) if found else np.zeros(0, np.int64)
    return train(rows, cols, np.array([r.label for r in found], float), names, swapped, float(prior))


class _Weighted(dict):
    """chunk -> the weighted features in it; emptied when full."""

    def __init__(self, weights):
        self.weights = weights

    def __missing__(self, chunk: str) -> frozenset[str]:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        found = frozenset(f for f in features(chunk) if f in self.weights)
        if len(chunk) <= 64:
            self[chunk] = found
        return found


def _score_batches(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fitted = model.value
    cache = _Weighted(fitted.weights) if fitted is not None else None
    for batch in batches:
        scores = np.full(batch.num_rows, 0.5)
        for i, text in enumerate(values(batch.column(0))) if fitted is not None else ():
            found = frozenset().union(*set(map(cache.__getitem__, set(text.split())))) if text else ()
            margin = fitted.intercept + sum(map(fitted.weights.__getitem__, sorted(found)))
            scores[i] = 1 / (1 + np.exp(-margin))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])


def toxicity_scores(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``docs`` with a column ``score``; ``docs`` must have its text in the first column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(partial(_score_batches, shared), f"{fields}, score double")
