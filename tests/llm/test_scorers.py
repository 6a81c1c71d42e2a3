"""Quality and toxicity: held-out accuracy, method checks, awkward rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starlens.llm import quality_knn, toxicity
from starlens.llm.queries import QUERIES
from tests.conftest import SF_CHECK
from tests.llm.odd import LONG, ROWS, odd_documents, odd_labels

SF_LARGE = SF_CHECK.replace("sf0.01", "sf0.1")


def auc(label, score):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


@pytest.mark.parametrize(
    ("key", "label", "modulus", "remainder", "least"), [("op1_quality", "quality", 5, 0, 0.99), ("op6_toxicity", "toxic", 4, 2, 0.95)]
)
def test_held_out_accuracy(spark, key, label, modulus, remainder, least):
    scored = QUERIES[key](spark, SF_LARGE)
    assert scored.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{SF_LARGE}/labels.parquet")
    rows = scored.join(labels, "doc_id").toPandas()
    from zlib import crc32

    assert all(h == (crc32(str(d).encode()) % modulus == remainder) for d, h in zip(rows.doc_id, rows.held_out, strict=True))
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.3) == (rows.predicted == 1)).all()
    held = rows[rows.held_out]
    assert auc(held[label].to_numpy(), held.score.to_numpy()) >= least
    clean = held[held.toxic == 0] if label == "toxic" else held[held.quality == 1]
    assert (clean.predicted == (0 if label == "toxic" else 1)).mean() >= 0.99


def test_neighbour_vote_is_brute_force_cosine():
    rng = np.random.default_rng(0)
    counts = rng.poisson(0.02, (40, quality_knn.DIMENSIONS)).astype(np.float32)
    labels = rng.integers(0, 2, 40)
    model = quality_knn.LatentNeighbours(counts, labels, rank=8, neighbours=5)
    assert model.vectors.shape == (40, 8)
    latent = quality_knn._unit(quality_knn._weighted(counts.copy(), model.idf) @ model.projection)
    for i, score in enumerate(model.scores(counts.copy())):
        cosine = latent[i] @ model.vectors.T
        near = np.argsort(-cosine)[:5]
        weight = np.maximum(cosine[near], 1e-3) ** quality_knn.SHARPNESS
        assert score == pytest.approx((weight * labels[near]).sum() / weight.sum(), rel=1e-4)


def test_counterfactual_penalty_evens_out_identity_terms():
    # toxic documents name one group, clean ones don't: without the penalty the term itself looks toxic
    neutral = [f"n{i}" for i in range(5)]
    names = ["vile", "muslims", "christians", "jews", *neutral]
    kinds = [["vile", "muslims"]] * 15 + [["muslims"]] * 15 + [["vile"]] * 10 + [[]] * 40 + [["christians"]] * 10
    documents = [[*d, neutral[i % 5]] for i, d in enumerate(kinds)]
    labels = np.array([1.0] * 40 + [0.0] * 50)
    rows = np.repeat(np.arange(90), [len(d) for d in documents])
    cols = np.array([names.index(f) for d in documents for f in d])
    pairs = Counter(p for d in documents for p in toxicity.swaps(" ".join(d)))
    assert pairs["muslims", "jews"] == 30 and pairs["christians", "muslims"] == 10
    pairs = [(gone, come, n) for (gone, come), n in pairs.items() if come in names]
    plain = toxicity.train(rows, cols, labels, names, pairs, 0.4, strength=0.0)
    fair = toxicity.train(rows, cols, labels, names, pairs, 0.4, strength=5.0)
    gap = lambda m: abs(m.weights.get("muslims", 0) - m.weights.get("christians", 0))
    assert gap(plain) > 0.5 and gap(fair) < 0.25 * gap(plain)
    assert fair.score("muslims n1") < plain.score("muslims n1")
    assert fair.score("vile") > 0.5


def test_swaps_are_the_feature_changes_of_rewritten_documents():
    rng = random.Random(6)
    words = ["muslims", "Christians", "jews", "people", "women", "men", "are", "kind", "ugly", "peoples", "womenfolk"]
    for _ in range(300):
        sentences = [" ".join(rng.choices(words, k=rng.randint(0, 6))) for _ in range(rng.randint(1, 4))]
        text = "".join(s + rng.choice([". ", "!\n", "? "]) for s in sentences)
        want = Counter()
        before = toxicity.features(text)
        for i, sentence in enumerate(sentences):
            for term in set(sentence.lower().split()) & set(toxicity.IDENTITY):
                for other in {o for kind in toxicity.KINDS.values() if term in kind for o in kind} - {term}:
                    rewritten = re.sub(rf"(?i)\b{term}\b", other, sentence)
                    after = toxicity.features(". ".join([*sentences[:i], rewritten, *sentences[i + 1 :]]))
                    if before != after:
                        gone, come = before - after, after - before
                        assert len(gone) <= 1 and len(come) <= 1
                        want["".join(gone), "".join(come)] += 1
        assert Counter(toxicity.swaps(text)) == want


def test_penalty_is_the_mean_squared_score_change():
    """The fitted weights are a stationary point of the whole objective, its penalty computed from rewritten documents."""
    rng = np.random.default_rng(2)
    names = ["muslims", "jews", "vile", "kind"]
    texts, labels = [], []
    for _ in range(120):
        toxic = rng.random() < 0.4
        group = rng.choice(["muslims", "jews", "muslims jews", ""], p=[0.6, 0.1, 0.1, 0.2] if toxic else [0.1, 0.4, 0.1, 0.4])
        texts.append(f"{group} {'vile' if toxic and rng.random() < 0.8 else 'kind'}. {rng.choice(['muslims kind', 'kind'])}")
        labels.append(float(toxic))
    labels = np.array(labels)
    found = [sorted(names.index(f) for f in toxicity.features(t) if f in names) for t in texts]
    rows, cols = np.repeat(np.arange(len(texts)), [len(f) for f in found]), np.concatenate(found)
    pairs = [(g, c, 1) for t in texts for g, c in toxicity.swaps(t) if {g, c} <= {*names, ""}]
    assert any(not g for g, _, _ in pairs) and any(not c for _, c, _ in pairs)
    strength = 2.0
    model = toxicity.train(rows, cols, labels, names, pairs, 0.4, strength=strength, steps=4000)
    w = np.array([model.weights.get(x, 0.0) for x in names])
    share = labels.mean()
    x = np.zeros((len(texts), 4))
    x[rows, cols] = 1
    scale = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    bias = model.intercept - np.log(0.4 / 0.6)
    value = lambda w, n: w[names.index(n)] if n else 0.0

    def objective(w, bias):
        margin = x @ w + bias
        loss = (scale * (np.logaddexp(0, margin) - labels * margin)).mean()
        changes = [(value(w, g) - value(w, c)) ** 2 for g, c, _ in pairs]
        return loss + 0.5 * (w @ w) / len(texts) + strength * np.mean(changes)

    chosen = np.flatnonzero(w)
    for i in chosen:
        step = np.zeros(4)
        step[i] = 1e-5
        assert abs(objective(w + step, bias) - objective(w - step, bias)) / 2e-5 < 1e-4
    assert len(chosen) >= 2


def test_awkward_rows_quality(spark):
    docs = odd_documents(spark)
    model = quality_knn.fit(docs, odd_labels(spark))
    got = quality_knn.quality_scores(docs.select("text", "doc_id"), model).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    by_text = {}
    for r in got:
        by_text.setdefault(r["text"] or "", set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())  # equal texts, null like empty
    assert quality_knn.fit(docs, odd_labels(spark).limit(0)) is None
    assert {r["score"] for r in quality_knn.quality_scores(docs.select("text", "doc_id"), None).collect()} == {0.5}
    ones = quality_knn.fit(docs, odd_labels(spark).where("quality = 1"))
    assert {r["score"] for r in quality_knn.quality_scores(docs.select("text"), ones).collect()} == {1.0}
    assert quality_knn.quality_scores(docs.limit(0).select("text", "doc_id"), model).count() == 0
    assert len(quality_knn.term_counts(LONG)) == quality_knn.DIMENSIONS


def test_awkward_rows_toxicity(spark):
    docs = odd_documents(spark)
    model = toxicity.fit(docs, odd_labels(spark))
    got = toxicity.toxicity_scores(docs.select("text", "doc_id"), model).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        assert r["score"] == pytest.approx(model.score(r["text"] or ""))
    assert toxicity.fit(docs, odd_labels(spark).limit(0)) is None
    assert {r["score"] for r in toxicity.toxicity_scores(docs.select("text"), None).collect()} == {0.5}
    assert toxicity.fit(docs, odd_labels(spark).where("toxic = 0")).score("idiot") < 0.01
    assert toxicity.toxicity_scores(docs.limit(0).select("text"), model).count() == 0


def test_sample_is_bounded_and_ignores_clashing_columns(spark):
    from starlens.llm.common import labelled_sample

    got = labelled_sample(odd_documents(spark), odd_labels(spark), "quality", 2, F.col("_id") < 9).collect()
    assert len(got) == 4 and sorted(r["label"] for r in got) == [0, 0, 1, 1]


def test_shapes_take_whole_chunks():
    from starlens.llm.quality_knn import shape

    head = "語" * 64
    assert shape(head + "Aa,9") != shape(head + "9,aA")
    assert shape("a-" * 30 + "9") != shape("a-" * 30 + "A")
