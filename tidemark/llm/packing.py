"""Pack documents into sequences of a fixed number of tokens.

Only the lengths of the pieces decide a packing, and there are no more different lengths than
tokens in a sequence. So the driver packs the histogram of lengths, whatever the number of
documents: Martello and Toth's dominance rules fix the sets that no alternative beats, and
best-fit decreasing places what is left. The plan says which ranks of each length go where;
Spark numbers the pieces of each length and joins them with it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import base
from tidemark.llm.byte_bpe import Encoder
from tidemark.sources import scratch

CAPACITY = 1024
END_ID = 2
GROUPS = 64
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(size: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: whole sequences after a first piece of what is left."""
    rest = size % capacity
    return [rest] * (rest > 0) + [capacity] * (size // capacity)


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids and the end id, cut into pieces; the first may be shorter.

    NULL texts are empty and have the end id alone. Rows that repeat a doc_id are separate
    documents.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for block in base.blocks(batches):
            rows = []
            texts = block.column("text").to_pylist()
            for doc_id, text in zip(block.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.array([*encoder.ids(text or ""), END_ID], "<u4").tobytes()
                start = 0
                for piece, length in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, piece, start, length, crc))
                    start += length
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names,
            )

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PIECES)


class _Lengths:
    """A histogram of lengths in ascending order that answers what still fits."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: n for k, n in sorted(counts.items()) if n > 0}
        self.order = list(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.order.remove(length)

    def largest(self, room: int, besides: dict[int, int]) -> int:
        """The largest length that fits once the pieces ``besides`` are taken out; 0 for none."""
        for place in range(bisect_right(self.order, room) - 1, -1, -1):
            length = self.order[place]
            if self.counts[length] > besides.get(length, 0):
                return length
        return 0

    def smallest_sum(self, pieces: int, besides: dict[int, int]) -> float:
        """The least sum of so many other pieces; infinite if there are not as many."""
        total = 0
        for length in self.order:
            n = min(pieces, self.counts[length] - besides.get(length, 0))
            total, pieces = total + n * length, pieces - n
            if not pieces:
                return total
        return float("inf")


def dominating(lengths: _Lengths, first: int, capacity: int) -> tuple[int, ...] | None:
    """A set with ``first`` that dominates every other set with it, if the rules prove one.

    With room r beside ``first`` and k the largest piece that fits: {first} if nothing fits;
    {first, k} if k fills r, if no two others fit, or if no three fit and no two have a sum
    above k; {first, k, b} with b the largest that fits beside k, if no three others fit and
    no piece up to r / 2 is above b, so that any pair can be exchanged for (k, b).
    """
    room, own = capacity - first, {first: 1}
    k = lengths.largest(room, own)
    if not k:
        return (first,)
    if k == room or lengths.smallest_sum(2, own) > room:
        return first, k
    if lengths.smallest_sum(3, own) <= room:
        return None
    best, place = 0, bisect_right(lengths.order, room) - 1
    for i in range(place, -1, -1):  # the largest sum of two others
        a = lengths.order[i]
        if 2 * a <= best:
            break
        if lengths.counts[a] <= own.get(a, 0):
            continue
        taken = {first: 1}
        taken[a] = taken.get(a, 0) + 1
        b = lengths.largest(room - a, taken)
        if b:
            best = max(best, a + b)
    if k >= best:
        return first, k
    taken = {first: 1}
    taken[k] = taken.get(k, 0) + 1
    b = lengths.largest(room - k, taken)
    if b and b >= lengths.largest(room // 2, own):
        return first, k, b
    return None


def reduce_by_dominance(
    counts: dict[int, int], capacity: int
) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Sets that are fixed for good, each with its number, and the lengths that remain.

    A rule that holds for a set holds as long as its pieces last, since taking pieces away
    leaves fewer alternatives; so equal sets are fixed together.
    """
    lengths, fixed, changed = _Lengths(counts), [], True
    while changed:
        changed = False
        for first in reversed(list(lengths.order)):
            while first in lengths.counts:
                found = dominating(lengths, first, capacity)
                if not found:
                    break
                n = min(lengths.counts[x] // found.count(x) for x in found)
                for length in found:
                    lengths.take(length, n)
                fixed.append((found, n))
                changed = True
    return fixed, lengths.counts


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing; sequences with the same content are kept as one entry."""
    by_room: dict[int, list[list]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted(r for r in by_room if r >= length):
            times = room // length  # a sequence is filled up before the next is begun
            for entry in by_room[room]:
                whole = min(entry[1], left // times)
                part = left - whole * times if whole < entry[1] else 0
                added = [((length,) * times, whole)] * (whole > 0)
                if 0 < part < times:
                    added.append(((length,) * part, 1))
                for extra, n in added:
                    rest = room - length * len(extra)
                    by_room.setdefault(rest, []).append([entry[0] + extra, n])
                    entry[1] -= n
                    left -= n * len(extra)
                if not left:
                    break
            by_room[room] = [entry for entry in by_room[room] if entry[1]]
            if not left:
                break
        times = capacity // length
        for extra, n in ((times, left // times), (left % times, 1)):
            if extra and n:
                rest = capacity - length * extra
                by_room.setdefault(rest, []).append([(length,) * extra, n])
    return [(tuple(pattern), n) for entries in by_room.values() for pattern, n in entries if n]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs of equally long pieces: length, first rank, end rank, first sequence, offset."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for pattern, n in [*fixed, *best_fit(rest, capacity)]:
        offset = 0
        for length in pattern:
            rank = used.get(length, 0)
            runs.append((length, rank, rank + n, sequence, offset))
            used[length] = rank + n
            offset += length
        sequence += n
    return runs


def pack(
    documents: DataFrame, path: str, capacity: int = CAPACITY, rows_per_group: int = 100_000
) -> DataFrame:
    """The pieces of all documents with their sequence and place.

    Pieces of a length are numbered in groups by a hash of the document, ``GROUPS`` or as many
    as keep a group at about ``rows_per_group`` rows, so that a length that most pieces share
    is no single task. The pieces are written once; the driver gets one row per length. An empty table gives none.
    """
    spark = documents.sparkSession
    cut_up = scratch.written(pieces(documents, path, capacity), "pieces")
    counts = {row["length"]: row["n"] for row in cut_up.groupBy("length").agg(
        F.count("*").alias("n")).collect()}
    groups = max(GROUPS, max(counts.values(), default=0) // rows_per_group)
    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
    grouped = cut_up.withColumn("group", group)
    sizes = grouped.groupBy("length", "group").agg(F.count("*").alias("n"))
    before = sizes.select(
        "length", "group",
        (F.sum("n").over(Window.partitionBy("length").orderBy("group")) - F.col("n")).alias("base"),
    )
    own = Window.partitionBy("length", "group").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = (
        grouped.withColumn("own", F.row_number().over(own) - 1)
        .join(before, ["length", "group"])
        .withColumn("rank", F.col("base") + F.col("own"))
        .drop("group", "own", "base")
    )
    runs = spark.createDataFrame(
        plan(counts, capacity),
        "run_length bigint, first bigint, end bigint, sequence bigint, offset bigint",
    )
    placed = numbered.join(
        F.broadcast(runs),  # as many rows as a sequence's tokens allow, however many pieces
        (F.col("length") == F.col("run_length"))
        & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("end")),
    )
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"),
        "offset",
    )
