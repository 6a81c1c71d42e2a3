"""The registered queries of this package: each applies one operator to a whole table.

``QUERIES[name](spark, sf_dir)`` returns the operator's full result in the
columns its contract names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.llm import (
    best_fit_packing,
    collocations,
    mtree_search,
    pii_semicrf,
    quality_knn,
    quality_rules,
    simhash_pivots,
    source_mixing,
    token_alignment,
    toxicity,
    warc_index,
    winnowing,
)
from starlens.llm.common import crc_remainder, table
from starlens.llm.token_counts import token_counts


#: A document with at least this score is predicted to have label 1.
CUT = 0.3


def _held_out(score: str, doc_id, modulus: int, remainder: int) -> list:
    """The contract's columns of a scored table."""
    held = F.coalesce(crc_remainder(doc_id, modulus) == remainder, F.lit(False))
    return ["doc_id", held.alias("held_out"), score, (F.col(score) >= CUT).cast("int").alias("predicted")]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_knn.fit(docs, table(spark, sf_dir, "labels"), crc_remainder(F.col("_id"), 5) != 0)
    scored = quality_knn.quality_scores(docs.select("text", "doc_id"), model)
    return scored.select(*_held_out("score", F.col("doc_id"), 5, 0))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii_semicrf.found_spans(docs, pii_semicrf.fit(docs))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree_search.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_remainder(F.col("_id"), 4) != 2)
    scored = toxicity.toxicity_scores(docs.select("text", "doc_id"), model)
    return scored.select(*_held_out("score", F.col("doc_id"), 4, 2))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_index.round_trip(table(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = best_fit_packing.packed(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096
    )
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = winnowing.edited_fingerprints(table(spark, sf_dir, "documents"), k=16, w=16)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.digest(F.col("selected")).alias("fingerprint"),
        winnowing.digest(F.col("edited_selected")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix_table(table(spark, sf_dir, "documents"), max_epochs=3, shard_words=8_000_000, seed=8)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash_pivots.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=3, max_distance=3)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabularies = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return token_alignment.alignments(table(spark, sf_dir, "documents"), *vocabularies)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=10, top=2000, inside_percent=50)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text"), into="rules")
    measured = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *(f"rules.measures.{c}" for c in measured), "rules.base_failed", "rules.kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_warc": op2_warc,
    "op3_packing": op3_packing,
    "op4_pii": op4_pii,
    "op5_top_k": op5_top_k,
    "op6_toxicity": op6_toxicity,
    "op7_winnowing": op7_winnowing,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_token_counts": op10_token_counts,
    "op11_token_alignment": op11_token_alignment,
    "op12_collocations": op12_collocations,
    "op13_quality_rules": op13_quality_rules,
}
