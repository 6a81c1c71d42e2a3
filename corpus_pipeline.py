"""The corpus pipeline: documents through the stages of ``STAGES``, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor
kept. All but the last return the columns of ``docs``; the last returns the
packed pieces of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.llm import best_fit_packing, pii_semicrf, quality_knn, simhash_pivots, source_mixing
from starlens.llm.common import free_name, prepare, table, written

#: Documents that score below are rejected.
QUALITY_CUT = 0.3
MAX_EPOCHS = 3
#: Words of an output shard on average, about 50 MB of text.
SHARD_WORDS = 8_000_000
SEED = 8


def _lengths(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, if it has that column, brought up to date with the text."""
    if "n_chars" not in docs.columns:
        return docs
    count = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.select(*(count.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of its own input, doesn't reject."""
    model = quality_knn.fit(docs, table(spark, sf_dir, "labels"))
    order = ["text", *(c for c in docs.columns if c != "text")]
    score = free_name(docs, "_score")
    scored = quality_knn.quality_scores(docs.select(*order), model, score)
    return scored.where(F.col(score) >= QUALITY_CUT).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_pivots.deduplicated(docs, words_per_shingle=3, max_distance=3).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by the kind's name."""
    prepare(spark)
    return _lengths(pii_semicrf.redacted(docs, pii_semicrf.fit(docs)))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix draws, as often as it draws them, by output shard."""
    return source_mixing.mixed(docs, max_epochs=MAX_EPOCHS, shard_words=SHARD_WORDS, seed=SEED)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every drawn document's pieces and their places in sequences of 4096 tokens."""
    rows = best_fit_packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: SQL can't express the trained stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
