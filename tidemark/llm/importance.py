"""Draw the documents that look most like a target, by importance weights and Gumbel noise.

Words (runs of up to ``size`` of them) fall into buckets by their crc32. A bucket's gain says
how much more often it occurs in the target than in the corpus; a document's weight is the mean
gain of its words. Adding Gumbel noise, which a hash of the id gives, and taking the highest
scores draws without replacement in proportion to the exponential of the weight.

The order is made by a distributed radix sort from the least significant digit on. The rows to
sort lie in chunks of ``chunk`` places. In each pass every chunk counts its digits, the counts'
prefix sums over (digit, chunk) tell where each chunk's rows of a digit begin, and a row's
destination is that place plus its number among the chunk's rows of the digit. Passes are
stable, so the last one leaves every row at its final rank. No task holds more than a chunk,
whatever the keys, and every pass is a written table.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import base, fitting
from tidemark.sources import scratch

BUCKETS = 10_000
SEED = "2024"
MIN_WORDS = 20
PERCENT = 10
#: Rows of a chunk, and bits of a digit, of the radix sort.
CHUNK = 1 << 18
DIGIT_BITS = 11
#: Fixed value: every ASCII byte that is no digit or letter separates words; A-Z are lowered.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
SCORED = "doc_id bigint, n_features bigint, n_words bigint, weight bigint, score bigint"
CHUNKS = "chunk bigint, high array<bigint>, low array<bigint>, row array<bigint>"
SLICES = "chunk bigint, place array<int>, high array<bigint>, low array<bigint>, row array<bigint>"


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Buckets:
    """The buckets of a text's features."""

    def __init__(self, size: int, buckets: int):
        self.size = size
        self.numbers = fitting.Numbers(lambda feature: zlib.crc32(feature) % buckets)

    def __call__(self, found: list[bytes]) -> np.ndarray:
        features: list[bytes] = []
        for n in range(1, self.size + 1):
            if n == 1:
                features += found
            else:
                features += [b" ".join(found[i : i + n]) for i in range(len(found) - n + 1)]
        return np.fromiter(map(self.numbers.__getitem__, features), np.int64, len(features))


def histogram(texts: DataFrame, size: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket: an array of fixed length."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Buckets(size, buckets)
        total = np.zeros(buckets, np.int64)
        for block in base.blocks(batches):
            for text in base.texts_as_bytes(block):
                found = of(words(text))
                if len(found):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier a bucket is in the target, with one count added
    to each bucket of either."""
    buckets = len(corpus)
    all_corpus, all_target = float(corpus.sum() + buckets), float(target.sum() + buckets)
    return np.array(
        [
            math.floor(
                1000 * math.log((float(t) + 1) * all_corpus / ((float(s) + 1) * all_target))
            )
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: str) -> int:
    """floor(1000 g) of a Gumbel number g that the seed and the id alone decide."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(
    documents: DataFrame, gain: np.ndarray, size: int = 1, seed: str = SEED
) -> DataFrame:
    """doc_id, number of features and words, weight and score of every row. A text without
    words (NULL or empty) has weight 0; a NULL doc_id counts as an empty one for the noise."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Buckets(size, len(gain))
        for block in base.blocks(batches):
            rows = []
            ids = block.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, base.texts_as_bytes(block), strict=True):
                found = words(text)
                features = of(found)
                n = len(features)
                weight = int(gain[features].sum()) // n if n else 0
                rows.append((doc_id, n, len(found), weight, weight + noise(doc_id, seed)))
            names = ["doc_id", "n_features", "n_words", "weight", "score"]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, SCORED)


def _digits(row: pa.Table, column: str, shift: int, sign: int, bits: int) -> np.ndarray:
    keys = row.column(column).combine_chunks().flatten().to_numpy().view(np.uint64)
    digits = ((keys ^ np.uint64(sign)) >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return digits.astype(np.int64)


def _chunked(rows: DataFrame, chunk: int) -> DataFrame:
    """The rows (high, low, row) as arrays in chunks of any order and at most ``chunk`` rows."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size = 0

        def out(part: pa.Table) -> pa.RecordBatch:
            lists = [pa.array([part.column(c).to_numpy()], pa.list_(pa.int64())) for c in names]
            return pa.RecordBatch.from_arrays(lists, names)

        names = ["high", "low", "row"]
        for batch in batches:
            kept.append(batch)
            size += batch.num_rows
            while size >= chunk:
                held = pa.Table.from_batches(kept)
                yield out(held.slice(0, chunk))
                kept, size = held.slice(chunk).to_batches(), size - chunk
        if size:
            yield out(pa.Table.from_batches(kept))

    arrays = "high array<bigint>, low array<bigint>, row array<bigint>"
    chunks = rows.select("high", "low", "row").mapInArrow(gather, arrays)
    return chunks.withColumn("chunk", F.monotonically_increasing_id())


def _pass(
    chunks: DataFrame, column: str, shift: int, sign: int, chunk: int, bits: int
) -> DataFrame:
    """The rows in the stable order of one digit, in chunks of exactly ``chunk`` places."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                n = np.bincount(_digits(row, column, shift, sign, bits))
                used = np.flatnonzero(n)
                name = np.full(len(used), row.column("chunk")[0].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name), pa.array(used), pa.array(n[used])], ["chunk", "digit", "n"]
                )

    counts = scratch.written(
        chunks.select("chunk", column).mapInArrow(count, "chunk bigint, digit bigint, n bigint"),
        "digit-counts",
    )
    # where each digit begins: a number per digit of so many bits, whatever the rows
    starts, at = [], 0
    for row in counts.groupBy("digit").agg(F.sum("n").alias("n")).orderBy("digit").collect():
        starts.append((row["digit"], at))
        at += row["n"]
    first = chunks.sparkSession.createDataFrame(starts, "digit bigint, start bigint")
    before = Window.partitionBy("digit").orderBy("chunk")
    offsets = (
        counts.withColumn("before", F.sum("n").over(before) - F.col("n"))
        .join(F.broadcast(first), "digit")
        .groupBy("chunk")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("digit", (F.col("start") + F.col("before")).alias("at")))
            ).alias("offsets")
        )
        .select("chunk", "offsets.digit", "offsets.at")
    )

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                digits = _digits(row, column, shift, sign, bits)
                order = np.argsort(digits, kind="stable")
                known = row.column("digit").combine_chunks().flatten().to_numpy()
                at = row.column("at").combine_chunks().flatten().to_numpy()
                n = np.bincount(digits)[known]
                own = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
                place = np.repeat(at, n) + own  # ascending, as the digits are
                values = [
                    row.column(c).combine_chunks().flatten().to_numpy()[order]
                    for c in ("high", "low", "row")
                ]
                cuts = [0, *(np.flatnonzero(np.diff(place // chunk)) + 1).tolist(), len(place)]
                out: dict[str, list] = {c: [] for c in ("chunk", "place", "high", "low", "row")}
                for a, b in pairwise(cuts):
                    out["chunk"].append(int(place[a] // chunk))
                    out["place"].append((place[a:b] % chunk).astype(np.int32))
                    for name, value in zip(("high", "low", "row"), values, strict=True):
                        out[name].append(value[a:b])
                kinds = [pa.int64(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 3]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[c], k) for c, k in zip(out, kinds, strict=True)], list(out)
                )

    def place(slices: pa.Table) -> pa.Table:
        slices = slices.combine_chunks()
        order = np.argsort(slices.column("place").combine_chunks().flatten().to_numpy())
        arrays = [
            pa.array([slices.column(c).combine_chunks().flatten().to_numpy()[order]],
                     pa.list_(pa.int64()))
            for c in ("high", "low", "row")
        ]
        return pa.Table.from_arrays(
            [slices.column("chunk").slice(0, 1), *arrays], ["chunk", "high", "low", "row"]
        )

    sent = chunks.join(offsets, "chunk").mapInArrow(send, SLICES)
    return sent.groupBy("chunk").applyInArrow(place, CHUNKS)


def ranked(
    rows: DataFrame, keys: tuple[str, str], chunk: int = CHUNK, bits: int = DIGIT_BITS
) -> DataFrame:
    """``row`` and its rank from 1 on, by two integer columns ascending; NULLs count as larger
    than all others (or, where the values differ by 63 bits, as the largest bigint). Rows with
    equal keys keep the order in which they are first gathered. Bits in which no keys differ
    need no pass.

    ``rows`` is a written table with a column ``row``.
    """
    if chunk < 1 or not 1 <= bits <= 16:
        raise ValueError("a chunk holds at least a row, a digit 1 to 16 bits")
    named = dict(zip(("low", "high"), (keys[1], keys[0]), strict=True))
    bounds = rows.agg(
        *[F.min(k).alias(f"{c}_min") for c, k in named.items()],
        *[F.max(k).alias(f"{c}_max") for c, k in named.items()],
    ).first()
    moved, passes = [], []
    for column, key in named.items():  # the least significant first
        least, most = bounds[f"{column}_min"] or 0, bounds[f"{column}_max"] or 0
        value, sign, last = F.col(key).cast("bigint"), 0, most - least + 1
        if last < 1 << 63:
            value = F.coalesce(value - F.lit(least), F.lit(last))
            width = last.bit_length()
        else:  # as they are, with the sign bit turned
            value, sign, width = F.coalesce(value, F.lit((1 << 63) - 1)), 1 << 63, 64
        moved.append(value.alias(column))
        passes += [(column, shift, sign) for shift in range(0, width, bits)]
    chunks = scratch.written(_chunked(rows.select(*moved, "row"), chunk), "radix-pass")
    for column, shift, sign in passes:
        chunks = scratch.written(_pass(chunks, column, shift, sign, chunk, bits), "radix-pass")
    return chunks.select("chunk", F.posexplode("row").alias("place", "row")).select(
        "row", (F.col("chunk") * chunk + F.col("place") + 1).alias("rank")
    )


def draw(
    documents: DataFrame, target: DataFrame, *, size: int = 1, buckets: int = BUCKETS,
    seed: str = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT,
    chunk: int = CHUNK, bits: int = DIGIT_BITS,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row.

    Of the rows with at least ``min_words`` words, ``percent`` percent (rounded down) with the
    highest scores have a rank, equal scores by smaller doc_id, a NULL id last; the others have
    none. Rows that repeat are drawn one by one. An empty table gives none; an empty target
    gives gains all the same.
    """
    gain = gains(histogram(documents, size, buckets), histogram(target, size, buckets))
    scored = scratch.written(
        score(documents, gain, size, seed).withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    able = scored.filter(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    keys = able.select((-F.col("score")).alias("down"), "doc_id", "row")
    ranks = ranked(keys, ("down", "doc_id"), chunk, bits).filter(F.col("rank") <= drawn)
    return scored.join(ranks, "row", "left").select(
        "doc_id", "n_features", "weight", "score", "rank"
    )
