"""Toxicity of a document by subword-bag embeddings and a linear softmax.

A word is the bag of its character n-grams and itself, each hashed to a row of an embedding
table. The rows of ``SEGMENT`` consecutive words are averaged and a linear softmax over
{clean, toxic} reads the average; a document is as toxic as its most toxic segment, so that
length does not dilute it. Embeddings and softmax are trained together on the documents'
labels: while training, segments are weighed by how toxic they look, ever more sharply, and
toxic documents count ``TOXIC_WEIGHT`` times, since a toxic word shares its segment with others.
Misspelled words share most of their n-grams with the right ones, and so their vectors.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, fitting

BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (2, 3, 4, 5)
SEGMENT = 3
TOXIC_WEIGHT = 8.0
THRESHOLD = 0.7
ROWS_PER_CLASS = 4_000
SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"
WORD = re.compile(r"\w+")
#: Odd constants of the hash.
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def split(text: bytes) -> list[str]:
    return WORD.findall(text.decode("utf-8", "replace").lower())


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of ``<word>`` and of the word itself, and where words start."""
    letters = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32)
    letters = letters.astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    starts = ends - lengths
    left = np.repeat(ends, lengths) - np.arange(len(letters))  # letters up to the word's end
    word = np.repeat(np.arange(len(words)), lengths)
    owners, found = [], []
    with np.errstate(over="ignore"):
        code = np.zeros(len(letters), np.uint64)
        for n in range(1, min(max(GRAMS), len(letters)) + 1):  # one short word has no longer ones
            code[: len(letters) - n + 1] = (
                code[: len(letters) - n + 1] * STEP + letters[n - 1 :] + np.uint64(1)
            )
            if n in GRAMS:
                inside = left >= n
                owners.append(word[inside])
                found.append(code[inside] + np.uint64(n))
        powers = np.arange(len(letters), dtype=np.uint64) - np.repeat(starts, lengths).astype(
            np.uint64
        )
        whole = np.add.reduceat((letters * STEP) ^ (powers * MIX), starts) if len(words) else code
        owners.append(np.arange(len(words)))
        found.append(whole)
        codes = np.concatenate(found) * MIX
        buckets = ((codes ^ (codes >> np.uint64(32))) * STEP >> np.uint64(40)).astype(np.int64)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return buckets[order] % BUCKETS, np.searchsorted(owner[order], np.arange(len(words)))


def segments(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the segments of texts with so many words, and the first segment of each text
    (with words); texts follow each other without gaps."""
    n = -(-lengths // SEGMENT)
    first = np.cumsum(n) - n
    begins = np.cumsum(lengths) - lengths
    place = np.arange(n.sum()) - np.repeat(first, n)
    return np.repeat(begins, n) + SEGMENT * place, first


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Word numbers of all texts in a row, words per text, and the words."""
    known: dict[str, int] = {}
    parts, lengths = [], []
    for text in texts:
        own = split(text)
        lengths.append(len(own))
        parts.append(np.fromiter((known.setdefault(w, len(known)) for w in own), np.int64, len(own)))
    numbers = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return numbers, np.array(lengths, np.int64), list(known)


def train(
    texts: list[bytes], n_chars: list, labels: np.ndarray, epochs: int = 120, rate: float = 0.05,
    dropout: float = 0.3, decay: float = 1e-6,
) -> dict[str, np.ndarray]:
    """Fit embeddings and softmax together.

    In each epoch a word has only some of its n-grams, so that no single one decides: what is
    left of a misspelled word must be enough.
    """
    dice = np.random.default_rng(11)
    embeddings = (0.1 * dice.standard_normal((BUCKETS, DIMENSIONS))).astype(np.float32)
    softmax = (0.1 * dice.standard_normal((DIMENSIONS, 2))).astype(np.float32)
    bias = np.array([0.0, -1.0], np.float32)
    numbers, lengths, words = _numbered(texts)
    model = {"embeddings": embeddings, "softmax": softmax, "bias": bias}
    if not len(words):
        return model
    filled = lengths > 0
    labels, lengths = labels[filled], lengths[filled]
    weights = np.where(labels == 1, np.float32(TOXIC_WEIGHT), np.float32(1))
    grams, word_starts = subwords(words)
    grams_of = np.diff(np.append(word_starts, len(grams)))
    begins, first = segments(lengths)
    per_text = np.diff(np.append(first, len(begins)))
    words_in = np.diff(np.append(begins, len(numbers)))
    adam = fitting.Adam([embeddings, softmax, bias], rate)
    for epoch in range(epochs):
        direction = softmax[:, 1] - softmax[:, 0]
        weight = embeddings @ direction
        kept = dice.random(len(grams), np.float32) >= dropout
        of_word = np.add.reduceat(weight[grams] * kept, word_starts)
        left = np.add.reduceat(kept, word_starts, dtype=np.float32)
        size = np.maximum(np.add.reduceat(left[numbers], begins), 1)  # of each bag
        z = np.add.reduceat(of_word[numbers], begins) / size
        sharp = 1 + 9 * min(1, epoch / (0.5 * epochs))
        top = np.maximum.reduceat(z, first)
        share = np.exp(np.clip(sharp * (z - np.repeat(top, per_text)), -60, 0))
        share /= np.repeat(np.add.reduceat(share, first), per_text)
        pooled = np.add.reduceat(share * z, first)
        logit = pooled + bias[1] - bias[0]
        error = (fitting.sigmoid(logit) - labels) * weights / len(labels)
        on_segment = np.repeat(error, per_text) * share / size
        on_word = np.bincount(numbers, np.repeat(on_segment, words_in), len(words))
        on_gram = np.bincount(grams, np.repeat(on_word, grams_of) * kept, BUCKETS)
        on_gram = on_gram.astype(np.float32)
        on_direction = embeddings.T @ on_gram
        on_bias = np.float32(error.sum())
        adam.step(
            [
                on_gram[:, None] * direction + decay * embeddings,
                np.stack([-on_direction, on_direction], axis=1),
                np.array([-on_bias, on_bias], np.float32),
            ]
        )
    return model


class Scorer:
    """Probabilities of texts; the part of each word seen is kept."""

    def __init__(self, model: dict, limit: int = 400_000):
        direction = model["softmax"][:, 1] - model["softmax"][:, 0]
        self.weight = (model["embeddings"] @ direction).astype(np.float64)
        self.bias = float(model["bias"][1] - model["bias"][0])
        self.limit = limit
        self.reset()

    def reset(self) -> None:
        self.known = fitting.Numbers(lambda w: len(self.known), 1 << 62)
        self.sums, self.sizes = np.zeros(0), np.zeros(0)

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.reset()
        before, parts = len(self.known), []
        for text in texts:
            own = split(text)
            parts.append(np.fromiter(map(self.known.__getitem__, own), np.int64, len(own)))
        new = list(self.known)[before:]
        if new:
            grams, starts = subwords(new)
            self.sums = np.append(self.sums, np.add.reduceat(self.weight[grams], starts))
            self.sizes = np.append(self.sizes, np.diff(np.append(starts, len(grams))))
        lengths = np.array([len(p) for p in parts], np.int64)
        pooled = np.zeros(len(texts))
        filled = lengths > 0
        if filled.any():
            numbers = np.concatenate(parts)
            begins, first = segments(lengths[filled])
            z = np.add.reduceat(self.sums[numbers], begins)
            z /= np.add.reduceat(self.sizes[numbers], begins)
            pooled[filled] = np.maximum.reduceat(z, first)
        return np.where(filled, fitting.sigmoid(pooled + self.bias), 0.0)


def fit(documents: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> dict:
    """Learn ``labels.toxic`` from the ids whose crc32 modulo 3 is not 1."""
    learn = base.crc_remainder("doc_id", 3) != 1
    rows = fitting.sample(documents, labels, "toxic", learn, rows_per_class)
    return fitting.fit(rows, train, 3 * rows_per_class)


def score(documents: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """Score every row by its whole text. A NULL text or one without words scores 0; repeated
    rows get equal scores."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # its size is a constant

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for block in base.blocks(batches):
            found = scorer(base.texts_as_bytes(block))
            ids = block.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "held_out": block.column("held_out").combine_chunks(),
                    "score": pa.array(found, pa.float64()),
                    "predicted": pa.array((found >= threshold).astype(np.int32)),
                }
            )

    held_out = (base.crc_remainder("doc_id", 3) == 1).alias("held_out")
    rows = documents.select(F.col("doc_id").cast("bigint"), "text", held_out)
    return rows.mapInArrow(run, SCHEMA)
