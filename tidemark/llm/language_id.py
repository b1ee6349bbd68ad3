"""Language of a document by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram is bound
from its letters' vectors, rotated by their place and multiplied; a text is the bundle (sum)
of its trigrams' vectors, and a language the bundle of its documents. The language whose
prototype has the highest cosine with the text is predicted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, fitting

DIMENSIONS = 1024
GRAM = 3
ROWS_PER_LANGUAGE = 1_000
UNKNOWN = "und"
SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"
#: Trigram vectors that a task keeps.
KEPT = 16_384


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """The lower-case letter of each code point, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            lower = letter.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


@lru_cache(maxsize=65_536)
def letter_vector(point: int) -> np.ndarray:
    """The same vector for a letter in every task; the gap between words is letter 0."""
    dice = np.random.Generator(np.random.PCG64([point, DIMENSIONS]))
    return (2 * dice.integers(0, 2, DIMENSIONS) - 1).astype(np.int8)


def trigrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's different trigrams and their counts; words are set apart by one gap."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    line = letters()[points]
    line = np.concatenate([[0], line, [0]]).astype(np.uint64)
    line = line[np.concatenate([[True], (line[1:] != 0) | (line[:-1] != 0)])]
    if len(line) < GRAM:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    shift = np.uint64(21)
    codes = (((line[:-2] << shift) | line[1:-1]) << shift) | line[2:]
    return np.unique(codes, return_counts=True)


def bound(code: int) -> np.ndarray:
    """The vector of a trigram."""
    mask = (1 << 21) - 1
    first, second, third = code >> 42, (code >> 21) & mask, code & mask
    return (
        np.roll(letter_vector(first), 2) * np.roll(letter_vector(second), 1) * letter_vector(third)
    )


class Bundler:
    """Bundles of texts; the vectors of trigrams met before are kept, up to a bound."""

    def __init__(self):
        self.places: dict[int, int] = {}
        self.vectors = np.zeros((KEPT, DIMENSIONS), np.float32)

    def __call__(self, text: bytes) -> np.ndarray:
        codes, counts = trigrams(text)
        total = np.zeros(DIMENSIONS, np.float32)
        step = KEPT // 4
        for at in range(0, len(codes), step):
            part = codes[at : at + step].tolist()
            if len(self.places) + len(part) > KEPT:
                self.places.clear()
            rows = [self.places.get(code, -1) for code in part]
            for i, code in enumerate(part):
                if rows[i] < 0:
                    rows[i] = self.places[code] = len(self.places)
                    self.vectors[rows[i]] = bound(code)
            total += counts[at : at + step].astype(np.float32) @ self.vectors[rows]
        return total


def sample(documents: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """Texts to learn from: ids whose crc32 modulo 5 is not 0, with a text and a language,
    about ``rows_per_language`` of each language, chosen by a hash of the id."""
    named = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        "text",
    ).filter((base.crc_remainder("doc_id", 5) != 0) & F.col("lang").isNotNull())
    return fitting.thinned(named.filter(F.col("text").isNotNull()), "lang", rows_per_language)


def fit(
    documents: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE
) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes, of length one. Each task bundles what it reads of a
    language, a few numbers per language go to the driver."""

    def bundle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler, sums = Bundler(), {}
        for block in base.blocks(batches):
            names = block.column("lang").to_pylist()
            for lang, text in zip(names, base.texts_as_bytes(block), strict=True):
                sums[lang] = sums.get(lang, 0) + bundler(text).astype(np.float64)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * DIMENSIONS),
                    "place": pa.array(np.arange(DIMENSIONS, dtype=np.int32)),
                    "value": pa.array(vector),
                }
            )

    parts = sample(documents, rows_per_language).select("lang", "text")
    found = (
        parts.mapInArrow(bundle, "lang string, place int, value double")
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))  # whole numbers: any order gives the same
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("vector"))
        .orderBy("lang")
        .collect()
    )
    names, vectors = [], []
    for row in found:
        vector = np.array([part["value"] for part in row["vector"]])
        if norm := np.linalg.norm(vector):
            names.append(row["lang"])
            vectors.append(vector / norm)
    return names, np.array(vectors, np.float32).reshape(len(names), DIMENSIONS)


def predict(documents: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """Language and cosine of every row's whole text, also of ids that were learnt from.

    ``und`` with score 0 for NULL texts, texts without a letter, and when no language was
    learnt. Of equal cosines the first language by name counts; repeated rows get equal
    results.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a vector per language

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prototypes = shared.value
        bundler = Bundler()
        for block in base.blocks(batches):
            found, scores = [], []
            for text in base.texts_as_bytes(block):
                vector = bundler(text)
                norm = float(np.linalg.norm(vector))
                if not norm or not names:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = prototypes @ vector / norm
                best = int(cosines.argmax())
                found.append(names[best])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
            ids = block.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "held_out": block.column("held_out").combine_chunks(),
                    "lang_pred": pa.array(found, pa.string()),
                    "score": pa.array(scores, pa.float64()),
                }
            )

    held_out = (base.crc_remainder("doc_id", 5) == 0).alias("held_out")
    rows = documents.select(F.col("doc_id").cast("bigint"), "text", held_out)
    return rows.mapInArrow(run, SCHEMA)
