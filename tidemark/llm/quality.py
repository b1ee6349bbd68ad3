"""Quality of a document by a factorisation machine.

Inputs are hashed words (their counts, scaled to length one), and binned statistics of the
text's structure and its stored length, one-hot. The machine weighs every input and, through
low-rank vectors, every pair of inputs:

    z = w0 + sum w_i x_i + 1/2 sum_f [ (sum v_if x_i)^2 - sum v_if^2 x_i^2 ]

The right side is linear in the number of inputs, and is how texts are scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, fitting

WORD_BUCKETS = 1 << 16
BINS = 32
THRESHOLD = 0.3
ROWS_PER_CLASS = 6_000
SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"

#: Classes of bytes that the statistics count.
OTHER, UPPER, LOWER, DIGIT, SPACE, LINE, END, COMMA, SYMBOL = range(9)
CLASSES = np.zeros(256, np.intp)
for _name, _class in (
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER), ("abcdefghijklmnopqrstuvwxyz", LOWER),
    ("0123456789", DIGIT), (" \t\r", SPACE), ("\n", LINE), (".!?", END), (",;:'\"()-", COMMA),
    ("#$%&*+/<=>@[\\]^_`{|}~", SYMBOL),
):
    CLASSES[np.frombuffer(_name.encode(), np.uint8)] = _class
STATISTICS = 14


def _share(part: float, whole: float, scale: int) -> int:
    return min(BINS - 1, int(scale * part / max(whole, 1)))


def _size(n: int) -> int:
    return min(BINS - 2, int(n).bit_length())


def statistics(text: bytes, words: list[bytes], buckets: np.ndarray, n_chars: int | None) -> list:
    """The bin of each statistic; ``n_chars`` is the length that the table states."""
    counts = np.bincount(CLASSES[np.frombuffer(text, np.uint8)], minlength=9)
    n = len(words)
    top = int(np.bincount(np.unique(buckets, return_inverse=True)[1]).max()) if n else 0
    lines = text.split(b"\n")
    filled = len(text) - counts[SPACE] - counts[LINE]
    return [
        _size(n),
        BINS - 1 if n_chars is None else _size(max(0, n_chars)),
        _share(counts[UPPER], counts[UPPER] + counts[LOWER], 20),
        _share(counts[DIGIT], filled, 40),
        _share(counts[END], filled, 60),
        _share(counts[COMMA], filled, 60),
        _share(counts[SYMBOL], filled, 60),
        _share(counts[OTHER], filled, 20),
        _share(len(np.unique(buckets)), n, 30),
        _share(top, n, 30),
        _share(int((buckets[1:] == buckets[:-1]).sum()), n, 30),
        min(BINS - 1, filled // max(n, 1)),
        _share(len(set(lines)), len(lines), 30),
        _size(len(text) // len(lines)),
    ]


def features(
    texts: list[bytes], n_chars: list, numbers: fitting.Numbers
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inputs of each text in rows: where rows start, which inputs, and their values."""
    rows, starts, keys, counts = [], [0], [], []
    for text, stated in zip(texts, n_chars, strict=True):
        words = text.lower().split()
        buckets = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        bins = statistics(text, words, buckets, stated)
        own, n = np.unique(buckets, return_counts=True)
        places = WORD_BUCKETS + BINS * np.arange(STATISTICS) + np.array(bins)
        keys += [own, places]
        counts += [n / np.sqrt((n * n).sum()) if len(n) else n, np.ones(STATISTICS)]
        rows.append(len(own) + STATISTICS)
    starts = np.concatenate([[0], np.cumsum(rows, dtype=np.int64)])
    if not texts:
        return starts, np.zeros(0, np.int64), np.zeros(0, np.float32)
    return starts, np.concatenate(keys), np.concatenate(counts).astype(np.float32)


def bucket(word: bytes) -> int:
    return zlib.crc32(word) % WORD_BUCKETS


def forward(model: dict, starts: np.ndarray, keys: np.ndarray, x: np.ndarray):
    """z of each row, and the sums that its gradient needs."""
    if len(starts) < 2:
        return np.zeros(0), np.zeros((0, model["v"].shape[1]))
    linear = np.add.reduceat(model["w"][keys] * x, starts[:-1])
    scaled = model["v"][keys] * x[:, None]
    sums = np.add.reduceat(scaled, starts[:-1], axis=0)
    squares = np.add.reduceat(scaled * scaled, starts[:-1], axis=0)
    return model["w0"][0] + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums


def train(
    texts: list[bytes], n_chars: list, labels: np.ndarray, rank: int = 6, epochs: int = 12,
    batch: int = 128, rate: float = 0.01, decay: float = 1e-6, least_steps: int = 400,
) -> dict[str, np.ndarray]:
    """Fit by Adam on the log-loss, in ``epochs`` passes or as many as make ``least_steps``;
    without labels of both classes every score is 0.5 or more
    on the side of the class there is."""
    dice = np.random.default_rng(7)
    size = WORD_BUCKETS + BINS * STATISTICS
    model = {
        "w0": np.zeros(1, np.float32),
        "w": np.zeros(size, np.float32),
        "v": (0.01 * dice.standard_normal((size, rank))).astype(np.float32),
    }
    model["v"][:WORD_BUCKETS] *= 0.1
    if not len(labels):
        return model
    numbers = fitting.Numbers(bucket)
    starts, keys, x = features(texts, n_chars, numbers)
    adam = fitting.Adam([model["w0"], model["w"], model["v"]], rate)
    passes = max(epochs, -(-least_steps * batch // len(labels)))
    for _ in range(passes):
        order = dice.permutation(len(labels))
        for at in range(0, len(order), batch):
            picked = order[at : at + batch]
            lengths = starts[picked + 1] - starts[picked]
            own = np.concatenate([[0], np.cumsum(lengths)])
            flat = np.repeat(starts[picked] - own[:-1], lengths) + np.arange(own[-1])
            k, values = keys[flat], x[flat]
            z, sums = forward(model, own, k, values)
            error = (fitting.sigmoid(z) - labels[picked]) / len(picked)
            gain = np.repeat(error, lengths) * values
            used, inverse = np.unique(k, return_inverse=True)
            pair = gain[:, None] * (np.repeat(sums, lengths, axis=0) - model["v"][k] * values[:, None])
            gw, gv = np.zeros_like(model["w"]), np.zeros_like(model["v"])
            gw[used] = np.bincount(inverse, gain) + decay * model["w"][used]
            for f in range(pair.shape[1]):
                gv[used, f] = np.bincount(inverse, pair[:, f]) + decay * model["v"][used, f]
            adam.step([np.array([error.sum()], np.float32), gw, gv])
    return model


def fit(documents: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> dict:
    """Learn ``labels.quality`` from the ids whose crc32 modulo 5 is not 0."""
    learn = base.crc_remainder("doc_id", 5) != 0
    rows = fitting.sample(documents, labels, "quality", learn, rows_per_class)
    return fitting.fit(rows, train, 3 * rows_per_class)


def _scorer(documents: DataFrame, model: dict):
    shared = documents.sparkSession.sparkContext.broadcast(model)  # its size is a constant

    def scores(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
        numbers = fitting.Numbers(bucket)
        for block in base.blocks(batches):
            n_chars = block.column("n_chars").to_pylist()
            inputs = features(base.texts_as_bytes(block), n_chars, numbers)
            yield block, fitting.sigmoid(forward(shared.value, *inputs)[0].astype(np.float64))

    return scores


def score(documents: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """Score every row by its whole text and stated length; NULL texts count as empty, NULL
    lengths have an input of their own. Repeated rows get equal scores."""
    scores = _scorer(documents, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, found in scores(batches):
            ids = block.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "held_out": block.column("held_out").combine_chunks(),
                    "score": pa.array(found, pa.float64()),
                    "predicted": pa.array((found >= threshold).astype(np.int32)),
                }
            )

    doc_id = F.col("doc_id").cast("bigint")
    rows = documents.select(
        doc_id, "text", F.col("n_chars").cast("bigint").alias("n_chars"),
        (base.crc_remainder("doc_id", 5) == 0).alias("held_out"),
    )
    return rows.mapInArrow(run, SCHEMA)


def keep(documents: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that score at least the threshold."""
    scores = _scorer(documents, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, found in scores(batches):
            yield from block.filter(pa.array(found >= threshold)).to_batches()

    return documents.mapInArrow(run, documents.schema)
