"""Find and remove documents that hold passages of a benchmark.

Each task builds suffix arrays over the words of its training documents, one array for every
few megabytes of text (a shard), and searches every suffix of every test item in them by
bisection. Matches are then followed word by word to their full length. A shard holds whole
documents, so nothing is shuffled.

Only suffixes that begin a run of test words as long as the shortest window are kept in an
array: no other suffix can hold a match. Words that no test item has share the number 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base

#: Fixed value: every ASCII byte that is no digit or letter separates words; A-Z are lowered.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
SCHEMA = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
    "contaminated boolean, items array<string>, longest bigint, longest_start bigint, "
    "longest_item string"
)


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class TestItems:
    """Test items as numbers of their words, and the windows and suffixes to look for."""

    __test__ = False

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.names = [name for name, _ in items]
        self.vocabulary = {w: i for i, w in enumerate({w: 0 for _, ws in items for w in ws}, 1)}
        lengths = np.array([len(ws) for _, ws in items], np.int64)
        ends = np.cumsum(lengths + 1) - 1  # a 0 stands after each item
        self.words = np.zeros(int(ends[-1]) + 1 + window, np.uint32)
        starts = ends - lengths
        for start, (_, ws) in zip(starts, items, strict=True):
            self.words[start : start + len(ws)] = [self.vocabulary[w] for w in ws]
        # the window that begins at a suffix: all of a short item, else `window` words
        item = np.repeat(np.arange(len(items)), lengths)
        place = np.arange(len(item)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        long = np.minimum(lengths, window)[item]
        whole = place + long <= lengths[item]
        self.item, self.length = item[whole], long[whole]
        self.at = starts[self.item] + place[whole]
        self.shortest = int(self.length.min())


def _keys(numbers: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The words from each place on as byte strings that sort as the numbers do."""
    rows = numbers[at[:, None] + np.arange(depth)].astype(">u4")
    return rows.view(f"S{4 * depth}").ravel()


def suffix_array(numbers: np.ndarray, depth: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffixes that begin ``shortest`` test words, sorted by their first
    ``depth`` words, and those words as keys. ``numbers`` ends with ``depth`` zeros."""
    run = numbers != 0
    eligible = run.copy()
    for step in range(1, shortest):
        eligible[: len(run) - step] &= run[step:]
        eligible[len(run) - step :] = False
    at = np.flatnonzero(eligible)
    keys = _keys(numbers, at, depth)
    order = np.argsort(keys, kind="stable")
    return at[order], keys[order]


def search(numbers: np.ndarray, tests: TestItems) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every occurrence of every window: its place in the shard, the window, and the words
    that match from there on, at least the window itself."""
    places, keys = suffix_array(numbers, tests.window, tests.shortest)
    low = _keys(tests.words, tests.at, tests.window).copy()
    rows = low.view(">u4").reshape(-1, tests.window)
    beyond = np.arange(tests.window) >= tests.length[:, None]
    rows[beyond] = 0
    high = low.copy()
    high.view(">u4").reshape(-1, tests.window)[beyond] = 0xFFFFFFFF
    first = np.searchsorted(keys, low, "left")
    count = np.searchsorted(keys, high, "right") - first
    window = np.repeat(np.arange(len(count)), count)
    rank = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
    place = places[first[window] + rank]
    matched = tests.length[window].copy()
    alive = np.arange(len(window))
    while len(alive):
        here = numbers[np.minimum(place[alive] + matched[alive], len(numbers) - 1)]
        there = tests.words[tests.at[window[alive]] + matched[alive]]
        alive = alive[(here == there) & (there != 0)]
        matched[alive] += 1
    return place, window, matched


def _report(
    documents: list[list[bytes]], sets: Iterable[TestItems], window: int
) -> dict[str, pa.Array]:
    """The columns of the schema after doc_id, for the documents of one shard."""
    sizes = np.array([len(d) for d in documents], np.int64)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    total = int(sizes.sum()) + len(sizes)
    covered = np.zeros(total + window + 1, np.int32)
    items: list[set[str]] = [set() for _ in documents]
    longest = [(0, 0, "")] * len(documents)
    for tests in sets:
        numbers = np.zeros(total + window + 1, np.uint32)
        for start, document in zip(starts, documents, strict=True):
            numbers[start : start + len(document)] = np.fromiter(
                map(tests.vocabulary.get, document, repeat(0)), np.uint32, len(document)
            )
        place, found, matched = search(numbers, tests)
        np.add.at(covered, place, 1)
        np.add.at(covered, place + tests.length[found], -1)
        owner = np.searchsorted(starts, place, "right") - 1
        item = tests.item[found]
        for pair in np.unique(owner * len(tests.names) + item):
            items[pair // len(tests.names)].add(tests.names[pair % len(tests.names)])
        best = np.lexsort((item, place, -matched, owner))
        for i in best[np.unique(owner[best], return_index=True)[1]]:
            document = owner[i]
            match = (int(matched[i]), int(place[i] - starts[document]), tests.names[item[i]])
            longest[document] = max(longest[document], match, key=lambda m: m[0])
    hit = np.concatenate([[0], np.cumsum(np.cumsum(covered) > 0)])
    n_hit = hit[starts + sizes] - hit[starts]
    lists = [sorted(found) for found in items]
    digests = [hashlib.sha256(",".join(found).encode()).hexdigest() for found in lists]
    return {
        "n_words": pa.array(sizes),
        "n_hit": pa.array(n_hit, pa.int64()),
        "n_items": pa.array([len(found) for found in lists], pa.int64()),
        "items_sha256": pa.array(digests, pa.string()),
        "contaminated": pa.array(n_hit > 0),
        "items": pa.array(lists, pa.list_(pa.string())),
        "longest": pa.array([m[0] for m in longest], pa.int64()),
        "longest_start": pa.array([m[1] if m[0] else None for m in longest], pa.int64()),
        "longest_item": pa.array([m[2] if m[0] else None for m in longest], pa.string()),
    }


def _test_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Broadcast]:
    """The items in blocks of about so many bytes, each broadcast by itself. The driver holds
    one block at a time, and so does a task."""
    name = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    context, block, size = benchmark.sparkSession.sparkContext, [], 0
    rows = benchmark.select(name.alias("name"), F.coalesce("text", F.lit("")).alias("text"))
    for row in rows.toLocalIterator():
        own = words(row.text.encode())
        if not own:
            continue
        block.append((row.name, own))
        size += len(row.text) + 8 * len(own)
        if size >= block_bytes:
            yield context.broadcast(TestItems(block, window))
            block, size = [], 0
    if block:
        yield context.broadcast(TestItems(block, window))


def matches(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 16 << 20
) -> DataFrame:
    """Per document: its words, the words inside an occurrence of a test window, the items
    with such windows, and the longest verbatim match with its place and item.

    A window is ``window`` consecutive words of an item, or all of a shorter item. Items
    without words have none; a NULL text has no words; an item without an id is called
    ``null``. Rows that repeat a doc_id are reported one by one. Of equally long matches the
    first in the document counts. Test items are searched in broadcast blocks of
    ``block_bytes``, whatever the size of the benchmark.
    """
    reports = _reporter(benchmark, window, block_bytes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, report in reports(batches):
            ids = block.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), **report})

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, SCHEMA)


def remove(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 16 << 20
) -> DataFrame:
    """The rows of ``documents``, with all their columns, that hold no test window."""
    reports = _reporter(benchmark, window, block_bytes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, report in reports(batches):
            yield from block.filter(pc.invert(report["contaminated"])).to_batches()

    return documents.mapInArrow(run, documents.schema)


def _reporter(benchmark: DataFrame, window: int, block_bytes: int):
    """Blocks of documents with what is found in them, for use inside tasks."""
    sets = list(_test_blocks(benchmark, window, block_bytes))

    def reports(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Table, dict]]:
        for block in base.blocks(batches):
            found = [words(text) for text in base.texts_as_bytes(block)]
            yield block, _report(found, _loaded(sets), window)

    return reports


def _loaded(sets: list[Broadcast]) -> Iterator[TestItems]:
    """One block of items after another; of several, a task keeps only the current one."""
    for block in sets:
        yield block.value
        if len(sets) > 1 and hasattr(block, "_value"):
            del block._value
