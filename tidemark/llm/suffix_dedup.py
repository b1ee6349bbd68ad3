"""Remove every byte inside a string of a given length that starts elsewhere too.

The repeats are read off a Burrows-Wheeler transform (BWT) and common prefixes (LCP) of a
collection, which are built a column at a time: each round puts one more symbol before every
member's suffix, re-sorts all suffixes stably by it (the symbols in sorted order are the BWT)
and updates the common prefixes of neighbours. A round reads and writes its column from and to
a file in order; only the current order and prefixes are in memory.

A corpus has rounds as many as its longest document, so the members are cut to where repeats
can be:

* Every window of ``length`` bytes has an anchor, the place of the smallest hash among its
  grams (the leftmost of equal ones). Equal windows have equal anchors at equal places.
* Windows with the same anchor form a fragment: bytes of fewer than two window lengths.
  Fragments whose anchor gram occurs nowhere else are dropped; the others are dealt to tasks
  by their anchor, in which each is one member, aligned at its anchor. Equal windows stand in
  the same column of the same task.
* Two suffixes of one column share a window exactly if their common prefix has ``length``
  bytes; neighbours in the order suffice to tell.

The windows of an anchor that occurs very often are dealt one by one, by their own bytes.
Texts with a copy are repeated as a whole and need no search of their own, but one of them is
a member for the others' sake.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, exchange
from tidemark.sources import scratch

LENGTH = 200
GRAM = 64
#: Occurrences of an anchor above which its windows are dealt one by one.
OFTEN = 200_000
#: Window starts that are looked at together.
STRETCH = 1 << 18
FRAGMENTS = (
    "part int, first int, hidden boolean, bytes binary, nodes array<bigint>, starts array<int>"
)
RUNS = "node bigint, places array<int>"
_dice = np.random.default_rng(20)
BYTE_CODES = _dice.integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
FACTOR = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(n: int, factor: int) -> np.ndarray:
    """Powers of an odd number modulo 2**64."""
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        out[1:] = factor & (1 << 64) - 1
        return np.multiply.accumulate(out)


POWERS = _powers(STRETCH + 4 * LENGTH, FACTOR)
INVERSES = _powers(STRETCH + 4 * LENGTH, pow(FACTOR, -1, 1 << 64))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the bytes from each place on."""
    n = len(data)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_CODES[data] * POWERS[:n])])
        code = (sums[gram:] - sums[:-gram]) * INVERSES[: n - gram + 1]
        code ^= code >> np.uint64(31)
        code *= MIX
        code ^= code >> np.uint64(29)
    return code


def anchored(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: its gram's hash, its place, the first and last start."""
    parts = []
    width = length - gram + 1
    place_bits = np.uint64((1 << 20) - 1)
    for at in range(0, len(text) - length + 1, STRETCH):
        data = np.frombuffer(text, np.uint8, min(STRETCH + length - 1, len(text) - at), at)
        code = gram_hashes(data, gram)
        marked = (code & ~place_bits) | np.arange(len(code), dtype=np.uint64)
        windows = len(code) - width + 1
        rows = -(-len(code) // width)
        padded = np.full(rows * width, ~np.uint64(0))
        padded[: len(code)] = marked
        table = padded.reshape(rows, width)
        ahead = np.minimum.accumulate(table, axis=1).ravel()
        behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
        anchor = (least & place_bits).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.append(first[1:], windows) - 1
        parts.append((code[anchor[first]], anchor[first] + at, first + at, last + at))
    if not parts:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


class Collection:
    """Byte strings aligned at a column, whose BWT and LCP are built from right to left.

    ``firsts`` gives the column of each string's first byte. The columns are kept in a file,
    last column first, and read in that order; symbol 0 stands where a string has no byte.
    """

    def __init__(self, strings: list[bytes], firsts: np.ndarray):
        self.size = len(strings)
        lengths = np.fromiter(map(len, strings), np.int64, self.size)
        self.low, self.high = int(firsts.min()), int((firsts + lengths).max())
        self.file = tempfile.TemporaryFile()  # gone with the task
        data = np.frombuffer(b"".join(strings), np.uint8)
        ends = np.cumsum(lengths)
        columns = self.high - self.low
        step = max(1, (32 << 20) // columns)  # strings that are turned into columns at a time
        shape = (columns, self.size)
        self.file.truncate(2 * columns * self.size)
        symbols = np.memmap(self.file, np.uint16, "r+", shape=shape)
        for at in range(0, self.size, step):
            some = slice(at, min(at + step, self.size))
            own = np.repeat(np.arange(some.stop - at), lengths[some])
            begin = ends[some] - lengths[some]
            inside = np.arange(ends[some][-1] - begin[0]) - np.repeat(begin - begin[0], lengths[some])
            square = np.zeros((columns, some.stop - at), np.uint16)
            column = np.repeat(firsts[some], lengths[some]) + inside - self.low
            square[columns - 1 - column, own] = data[begin[0] : ends[some][-1]].astype(np.uint16) + 1
            symbols[:, some] = square
        symbols.flush()
        del symbols
        self.file.seek(0)

    def rounds(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """After each round: its column, the strings in the order of their suffixes from there
        on, the common prefix of each with its predecessor, and the BWT, the symbols that the
        round put before the suffixes of the last."""
        order = np.arange(self.size)
        prefix = np.zeros(self.size + 1, np.int32)  # and a last one that ends the ranges
        for column in range(self.high - 1, self.low - 1, -1):
            symbols = np.frombuffer(self.file.read(2 * self.size), np.uint16)
            transform = symbols[order]
            moved = np.argsort(transform, kind="stable")
            ordered = transform[moved]
            between = np.minimum.reduceat(prefix, moved + 1)  # up to the next of the symbol
            same = (ordered[1:] == ordered[:-1]) & (ordered[1:] != 0)
            prefix = np.zeros(self.size + 1, np.int32)
            prefix[1:-1][same] = between[:-1][same] + 1
            order = order[moved]
            yield column, order, prefix[:-1], transform

    def repeated(self, length: int) -> np.ndarray:
        """For each column up to 0 and each string, whether its next ``length`` bytes stand in
        the same column of another string."""
        out = np.zeros((1 - self.low, self.size), bool)
        for column, order, prefix, _ in self.rounds():
            if column <= 0:
                long = prefix >= length
                long[:-1] |= long[1:]
                out[column - self.low, order[long]] = True
        return out


def _merged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Alternating starts and ends of the union of intervals."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    last = np.append(np.flatnonzero(new)[1:], len(starts)) - 1
    return np.stack([starts[new], reach[last]], axis=1).ravel()


def _fragments(parts: int, length: int, gram: int):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in base.blocks(batches):
            found: dict[tuple[int, int, bytes], list] = {}
            rows = zip(
                base.texts_as_bytes(block), block.column("node").to_pylist(),
                block.column("copies").to_pylist(), block.column("shared").to_pylist(), strict=True,
            )
            for text, node, copies, shared in rows:
                code, anchor, first, last = anchored(text, length, gram)
                short = (code >> np.uint64(16)).astype(np.int64)
                listed = np.array(shared, np.int64)
                plain = listed & exchange.HASH
                hot = np.isin(short, plain[listed >= exchange.OFTEN])
                for i in np.flatnonzero(np.isin(short, plain)):
                    if hot[i]:  # window by window
                        pieces = [(p, p, 0, None) for p in range(first[i], last[i] + 1)]
                    else:
                        pieces = [(first[i], last[i], int(first[i] - anchor[i]), int(short[i]))]
                    for begin, end, column, name in pieces:
                        own = text[begin : end + length]
                        if name is None:
                            name = xxhash.xxh3_64_intdigest(own)
                        entry = found.setdefault((name % parts, column, own), [False, [], []])
                        entry[0] |= copies > 1
                        entry[1].append(node)
                        entry[2].append(int(begin))
            out = [(*key, *entry) for key, entry in found.items()]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([o[0] for o in out], pa.int32()),
                    "first": pa.array([o[1] for o in out], pa.int32()),
                    "hidden": pa.array([o[3] for o in out], pa.bool_()),
                    "bytes": pa.array([o[2] for o in out], pa.binary()),
                    "nodes": pa.array([o[4] for o in out], pa.list_(pa.int64())),
                    "starts": pa.array([o[5] for o in out], pa.list_(pa.int32())),
                }
            )

    return cut


def _search(length: int):
    """Repeated bytes of each document, from the fragments of one part."""

    def search(rows: pa.Table) -> pa.Table:
        strings = rows.column("bytes").to_pylist()
        firsts = rows.column("first").to_numpy().astype(np.int64)
        hidden = rows.column("hidden").to_numpy()
        owners = [column.combine_chunks() for column in (rows.column("nodes"), rows.column("starts"))]
        counts = np.diff(owners[0].offsets.to_numpy())
        nodes, starts = (column.flatten().to_numpy() for column in owners)
        collection = Collection(strings, firsts)
        marks = collection.repeated(length)
        windows = np.fromiter(map(len, strings), np.int64, len(strings)) - length + 1
        column = np.arange(marks.shape[0])[:, None] + collection.low
        own = (column >= firsts) & (column < firsts + windows)
        marks = own & (marks | hidden | (counts > 1))
        edge = np.diff(np.pad(marks.T.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        which, begin = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        begin, end = begin + collection.low - firsts[which], end + collection.low - firsts[which]
        owner = np.repeat(np.cumsum(counts) - counts, 1)
        times = counts[which]
        flat = np.repeat(owner[which] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        node = nodes[flat]
        low = starts[flat] + np.repeat(begin, times)
        high = starts[flat] + np.repeat(end - 1 + length, times)
        order = np.argsort(node, kind="stable")
        node, low, high = node[order], low[order], high[order]
        names, at = np.unique(node, return_index=True)
        limits = np.append(at, len(node))
        return pa.table(
            {
                "node": pa.array(names, pa.int64()),
                "places": pa.array(
                    [_merged(low[a:b], high[a:b]) for a, b in zip(limits[:-1], limits[1:], strict=True)],
                    pa.list_(pa.int32()),
                ),
            }
        )

    return search


def _cleaned(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[tuple[pa.Table, list]]:
    """Blocks of texts with what is left of each and its removed runs."""
    for block in base.blocks(batches):
        out = []
        rows = zip(
            base.texts_as_bytes(block), block.column("copied").to_pylist(),
            block.column("runs").to_pylist(), strict=True,
        )
        for text, copied, runs in rows:
            if copied and len(text) >= length:
                out.append((b"", [(0, len(text))]))
                continue
            places = np.array([p for part in runs or [] for p in part], np.int64).reshape(-1, 2)
            if not len(places):
                out.append((text, []))
                continue
            spans = _merged(places[:, 0], places[:, 1]).reshape(-1, 2).tolist()
            keep = np.ones(len(text), bool)
            for begin, end in spans:
                keep[begin:end] = False
            out.append((np.frombuffer(text, np.uint8)[keep].tobytes(), [tuple(s) for s in spans]))
        yield block, out


def _with_runs(
    documents: DataFrame, length: int, gram: int, often: int, block_bytes: int
) -> DataFrame:
    """doc_id, text, ``copied`` and the repeated places of each document.

    The texts are moved once, into a table laid out by text and id; what is found about them
    is brought to that table.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    laid_out = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    laid_out = laid_out.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("rid"),
        F.md5(F.col("text").cast("binary")).alias("digest"),
        "text",
    )
    texts = scratch.bucketed(laid_out, "texts", parts, ["digest", "rid"])
    first = scratch.written(
        texts.groupBy("digest", "rid")
        .agg(F.count("*").alias("rows"), F.first(F.octet_length("text")).alias("bytes"))
        .groupBy("digest")
        .agg(F.min(F.struct("rid", "rows")).alias("least"), F.sum("rows").alias("copies"),
             F.first("bytes").alias("bytes"))
        .filter(F.col("bytes") >= length)
        .select("digest", "least.*", "copies", "bytes",
                F.monotonically_increasing_id().alias("node")),
        "first-texts",
    )
    sizes = first.agg(F.sum(F.col("bytes").cast("bigint")), F.max("rows")).first()
    total, rows_alike = sizes[0] or 0, sizes[1] or 1

    def maker():
        def of_text(content: bytes) -> tuple[None, np.ndarray]:
            return None, anchored(content, length, gram)[0]

        return of_text

    members = texts.join(first, ["digest", "rid"]).select(
        F.col("node").alias("id"), "text"
    )
    repeated = exchange.shared(
        members, exchange.of_texts(maker), listed=True, often=often, block_bytes=block_bytes,
        total_bytes=total,
    )
    repeated = repeated.filter("n_shared > 0").select(F.col("id").alias("node"), "shared")
    if rows_alike > 1:  # rows of equal id and text are one member
        repeated = repeated.dropDuplicates(["node"])
    wanted = scratch.written(first.join(repeated, "node"), "repeated-anchors")
    fragments = (
        texts.join(wanted, ["digest", "rid"])
        .select("node", "copies", "shared", "text")
        .mapInArrow(_fragments(exchange.bucket_count(spark, total), length, gram), FRAGMENTS)
    )
    runs = (
        fragments.groupBy("part")
        .applyInArrow(_search(length), RUNS)
        .groupBy("node")
        .agg(F.collect_list("places").alias("runs"))
    )
    known = scratch.written(first.join(runs, "node", "left").drop("node"), "repeated-places")
    return texts.join(known, ["digest", "rid"], "left").select(
        "doc_id",
        "text",
        # a text without a row of its own is a further copy of one that has
        (F.coalesce("copies", F.lit(2)) > 1).alias("copied"),
        "runs",
    )


def find(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, often: int = OFTEN,
    block_bytes: int = base.BLOCK_BYTES,
) -> DataFrame:
    """Per row: doc_id, bytes of the text, bytes removed, maximal removed runs, the SHA-256 of
    what is left, and ``removed``, the runs as starts and ends (exclusive).

    Texts are UTF-8 bytes; NULL texts are empty; texts shorter than ``length`` lose nothing.
    Repeated rows are copies of each other and lose all bytes if they are long enough.
    """
    schema = (
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "removed array<int>"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, cleaned in _cleaned(batches, length):
            sizes = [len(t) for t in base.texts_as_bytes(block)]
            kept = [len(t) for t, _ in cleaned]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(block.column("doc_id").to_pylist(), pa.int64()),
                    "n_bytes": pa.array(sizes, pa.int64()),
                    "n_removed": pa.array(np.array(sizes) - np.array(kept), pa.int64()),
                    "n_spans": pa.array([len(spans) for _, spans in cleaned], pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t, _ in cleaned]),
                    "removed": pa.array(
                        [[p for span in spans for p in span] for _, spans in cleaned],
                        pa.list_(pa.int32()),
                    ),
                }
            )

    return _with_runs(documents, length, gram, often, block_bytes).mapInArrow(run, schema)
