"""Bounded samples of labelled documents, and fitting a model in one task."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The most text that a fit takes in, beside its bound on rows.
SAMPLE_BYTES = 192 << 20
#: The most classes of a classifier.
MAX_GROUPS = 10_000


def thinned(rows: DataFrame, group: str, rows_per_group: int) -> DataFrame:
    """About ``rows_per_group`` rows of each group, or all of a smaller one: those whose
    doc_id has a hash below the share that the group's count asks for. The counts, a row per
    group, are broadcast; more than ``MAX_GROUPS`` classes are refused."""
    counts = rows.groupBy(group).agg(F.count("*").alias("_rows"))
    found = counts.limit(MAX_GROUPS + 1).collect()
    if len(found) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} different values of {group} to learn")
    known = rows.sparkSession.createDataFrame(found, counts.schema)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    share = F.lit(float(rows_per_group)) / F.col("_rows")
    return rows.join(F.broadcast(known), group).filter(place < share).drop("_rows")


def sample(
    documents: DataFrame, labels: DataFrame, label: str, learn: Column, rows_per_class: int
) -> DataFrame:
    """About ``rows_per_class`` documents of each class, chosen by a hash of the doc_id.

    ``learn`` says which ids may be learnt from. An id with several labels has the highest;
    ids without a label take no part. Of the documents, only the chosen ones are moved.
    """
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    texts = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
    )
    # two classes of rows_per_class ids each, however many documents there are
    return texts.join(F.broadcast(thinned(known, "label", rows_per_class)), "doc_id")


def fit(
    rows: DataFrame,
    train: Callable[[list[bytes], list, np.ndarray], dict[str, np.ndarray]],
    max_rows: int,
) -> dict[str, np.ndarray]:
    """Run ``train`` on the texts, n_chars and labels of a sample in one task.

    Ids that repeat in the documents can make the sample larger than it was chosen; rows past
    ``max_rows`` or ``SAMPLE_BYTES`` of text, in order of id, take no part in the fit.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, n_chars, labels, size = [], [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if len(texts) < max_rows and size < SAMPLE_BYTES:
                    texts.append(row["text"].encode())
                    n_chars.append(row["n_chars"])
                    labels.append(row["label"])
                    size += len(texts[-1])
        file = io.BytesIO()
        np.savez(file, **train(texts, n_chars, np.array(labels, np.float32)))
        yield pa.RecordBatch.from_pydict({"model": pa.array([file.getvalue()], pa.binary())})

    ordered = rows.repartition(1).sortWithinPartitions("doc_id", "text", "n_chars")
    found = ordered.mapInArrow(run, "model binary").collect()
    if not found:  # an empty table has no partition to run in
        return train([], [], np.zeros(0, np.float32))
    with np.load(io.BytesIO(bytes(found[0]["model"]))) as file:
        return {name: file[name] for name in file.files}


class Numbers(dict):
    """A cache from words to numbers; ``number`` makes the missing ones."""

    def __init__(self, number: Callable[[bytes], int], limit: int = 500_000):
        super().__init__()
        self.number, self.limit = number, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.number(word)
        return value


class Adam:
    """Adam steps on arrays that are changed in place."""

    def __init__(self, arrays: list[np.ndarray], rate: float):
        self.arrays, self.rate, self.steps = arrays, rate, 0
        self.first = [np.zeros_like(a) for a in arrays]
        self.second = [np.zeros_like(a) for a in arrays]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.steps += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for a, g, m, v in zip(self.arrays, gradients, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= (rate * m / (np.sqrt(v) + 1e-8)).astype(a.dtype)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
