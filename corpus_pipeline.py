"""From raw documents to packed training sequences.

Each stage takes the rows that the one before it kept, as a table read back from Parquet, and
all but the last give rows with the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import base, decontaminate, jaccard_join, line_dedup, packing, quality
from tidemark.sources import scratch

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones among them, accepts."""
    model = quality.fit(docs, base.table(spark, sf_dir, "labels"))
    return quality.keep(docs, model)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the chunks of lines that an earlier document has, and without
    the shorter repeated runs that no whole chunk covers."""
    return line_dedup.remove_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.remove(docs, base.table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1,024 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: A fitted model and a tokenizer are no SQL; tests/llm/test_pipeline.py checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch.lifetime(spark):  # what a stage writes besides its rows goes with it
            rows = stage(spark, docs, sf_dir)
            docs = scratch.written(rows, f"stage-{name.replace(' ', '-')}", outside=True)
    return STAGES[-1][1](spark, docs, sf_dir)
