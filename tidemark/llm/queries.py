"""The operators over the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    alignment,
    base,
    credentials,
    decontaminate,
    importance,
    jaccard_join,
    language_id,
    line_dedup,
    packing,
    pii,
    quality,
    spotsigs,
    suffix_dedup,
    toxicity,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.find(base.table(spark, sf_dir, "documents"))


def op1_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.find_runs(base.table(spark, sf_dir, "documents"))


def op2_spotsigs_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spotsigs.compare_with_next(base.table(spark, sf_dir, "documents"))
    return found.drop("n_signatures")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.cluster(base.table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = base.table(spark, sf_dir, "documents")
    found = decontaminate.matches(documents, base.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = base.table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, base.table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(base.table(spark, sf_dir, "documents")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = base.table(spark, sf_dir, "documents")
    return language_id.predict(documents, language_id.fit(documents))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.find(base.table(spark, sf_dir, "documents")).drop("removed")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = base.table(spark, sf_dir, "documents")
    model = quality.fit(documents, base.table(spark, sf_dir, "labels"))
    return quality.score(documents, model)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(base.table(spark, sf_dir, "documents"), TOKENIZER)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(credentials.find(base.table(spark, sf_dir, "documents")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = base.table(spark, sf_dir, "documents")
    return importance.draw(documents, base.table(spark, sf_dir, "benchmark"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(base.table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


QUERIES = {
    name: run for name, run in list(globals().items()) if name.startswith("op")
}
