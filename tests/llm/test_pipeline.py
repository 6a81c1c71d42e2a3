"""The pipeline: each stage against brute force on its own input, awkward rows through all of it."""

from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline as pipeline
from starlens.llm import quality_knn
from starlens.llm.common import written
from tests.conftest import SF_SMALL
from tests.llm.odd import odd_documents, odd_labels
from tests.llm.test_corpus_operators import check_packing, plain_fingerprint, roots
from tests.llm.test_text_operators import by_patterns


@pytest.fixture(scope="module")
def stages(spark):
    """name -> (input rows, output rows) of every stage at sf0.001, written and read again in between."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        result = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        if name != "packing":
            assert result.columns == docs.columns
        out[name] = (docs.collect(), result.collect())
        docs = result
    return out


def test_stage_list():
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "source_mix", "packing"]
    assert "pipeline" in __spark_entry__.queries() and "pipeline" not in __spark_entry__.oracle_sql()


def test_quality_rejects_what_scores_low(spark, stages):
    before, after = stages["quality"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = quality_knn.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    keep = {
        r["doc_id"] for r in before
        if model.scores(quality_knn.term_counts(r["text"] or "")[None, :])[0] >= pipeline.QUALITY_CUT
    }
    assert {r["doc_id"] for r in after} == keep and len(keep) < len(before)
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").collect()}
    assert len(good & keep) >= 0.98 * len(good)  # clean documents stay


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    fps = {r["doc_id"]: plain_fingerprint(r["text"] or "") for r in before}
    root = roots(set(fps.values()), 3)
    least = {}
    for d, f in fps.items():
        least[root[f]] = min(least.get(root[f], d), d)
    assert sorted(r["doc_id"] for r in after) == sorted(least.values())
    assert Counter(map(tuple, after)) - Counter(map(tuple, before)) == Counter()


def test_personal_data_is_replaced_and_the_rest_kept(stages):
    before, after = stages["personal_data"]
    texts = {r["doc_id"]: r["text"] for r in before}
    assert Counter(r["doc_id"] for r in before) == Counter(r["doc_id"] for r in after)
    for r in after:
        spans = by_patterns(texts[r["doc_id"]])
        assert not by_patterns(r["text"]) and r["n_chars"] == len(r["text"])
        if not spans:
            assert r["text"] == texts[r["doc_id"]]
        else:
            first = spans[0][0]
            assert r["text"][: first] == texts[r["doc_id"]][: first] and r["text"][first] == "<"


def test_mix_draws_documents_to_their_targets(stages):
    before, after = stages["source_mix"]
    rows = {tuple(r) for r in before}
    drawn = Counter(map(tuple, after))
    assert set(drawn) <= rows and max(drawn.values()) <= pipeline.MAX_EPOCHS
    size = lambda t: len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w])
    total = sum(size(r["text"]) for r in before)
    taken = sum(size(r["text"]) for r in after)
    assert abs(taken - total) <= 0.1 * total


def test_packing_of_what_was_drawn(stages):
    before, after = stages["packing"]
    bins, bound = check_packing(after, [(r["doc_id"], r["text"]) for r in before], 4096)
    assert bins == bound


def test_awkward_rows_pass_through_all_stages(spark, scratch):
    for folder, docs in (("odd", odd_documents(spark)), ("empty", odd_documents(spark).limit(0))):
        docs.write.parquet(f"{scratch}/{folder}/documents.parquet")
        odd_labels(spark).write.parquet(f"{scratch}/{folder}/labels.parquet")
        rows = pipeline.run(spark, f"{scratch}/{folder}").collect()
        assert bool(rows) == (folder == "odd")
