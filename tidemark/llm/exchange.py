"""Which hashes of a document occur elsewhere, found with sorted arrays instead of rows.

Tasks send the hashes of a block of documents as sorted arrays, cut by hash range into buckets:
as many as the session has shuffle partitions, or more if the input would overfill them.
A bucket holds all occurrences of its range, so it knows which hashes repeat and answers each
block; the answers of a block are put together. A hash that occurs very often is an entry per
occurrence like any other, spread by nothing but its documents' blocks, and is never a group
of its own.

A block is named by its task, its place and its content, and every message says how many
the block has sent. Should a task that is run again meet its rows in another order, its blocks
have other names, and the join of the answers fails instead of mixing them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import base

#: Bytes of input whose hashes share a bucket, at most on average.
BUCKET_BYTES = 32 << 20
ASKED = (
    "bucket int, block string, parts int, hashes binary, owners binary, ids array<bigint>, "
    "keys array<string>"
)
ANSWERED = (
    "block string, parts int, totals binary, shared binary, listed binary, holders binary, "
    "ids array<bigint>, keys array<string>"
)
MERGED = "id bigint, key string, n bigint, n_shared bigint, shared array<bigint>"
#: A listed hash is its upper 48 bits, above them the bits that its count takes, and this one
#: if it occurs more than the limit of ``often``.
OFTEN = 1 << 62
COUNT_SHIFT = 56
HASH = (1 << 48) - 1
KINDS = {
    "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "bigint": pa.int64(),
    "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    "array<int>": pa.list_(pa.int32()), "boolean": pa.bool_(),
}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, KINDS[k]) for n, k in (column.split() for column in ddl.split(", "))])


def pack_sorted(hashes: np.ndarray) -> bytes:
    """Sorted hashes by their upper 48 bits, as steps of 32 bits where those suffice. Hashes
    that agree in 48 bits count as repeated, which makes a candidate and decides nothing."""
    if not len(hashes):
        return b""
    short = hashes >> np.uint64(16)
    steps = np.diff(short)
    if len(steps) and steps.max() >= 1 << 32:
        return b"w" + short.tobytes()
    return b"n" + short[:1].tobytes() + steps.astype(np.uint32).tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.uint64)
    if packed[:1] == b"w":
        return np.frombuffer(packed, np.uint64, offset=1)
    first = np.frombuffer(packed, np.uint64, 1, offset=1)
    steps = np.frombuffer(packed, np.uint32, offset=9).astype(np.uint64)
    return np.concatenate([first, first[0] + np.cumsum(steps, dtype=np.uint64)])


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """How often the hash at each place occurs among all."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.append(starts, len(ordered)))
    out = np.empty(len(hashes), np.int64)
    out[order] = np.repeat(counts, counts)
    return out


Hashes = list[tuple[str | None, np.ndarray]]


def of_texts(
    maker: Callable[[], Callable[[bytes], tuple[str | None, np.ndarray]]],
) -> Callable[[], Callable[[pa.Table], Hashes]]:
    """Keys and hashes of blocks from those of a text."""

    def make() -> Callable[[pa.Table], Hashes]:
        of_text = maker()
        return lambda block: [of_text(text) for text in base.texts_as_bytes(block)]

    return make


def bucket_count(spark: SparkSession, total_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Shuffle partitions, or as many buckets as so much input needs."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-total_bytes // bucket_bytes))


def bytes_of(rows: DataFrame, column: str) -> int:
    """The bytes of a column of texts or of lists of numbers."""
    is_list = isinstance(rows.schema[column].dataType, T.ArrayType)
    size = 8 * F.size(column).cast("bigint") if is_list else F.octet_length(column).cast("bigint")
    return rows.agg(F.sum(F.greatest(size, F.lit(0)))).first()[0] or 0


def _block_name(place: str, ids: list, lengths: np.ndarray, hashes: np.ndarray) -> str:
    """The place of a block, and a digest of what it sends."""
    digest = xxhash.xxh3_128(repr(ids).encode())
    digest.update(lengths.tobytes())
    digest.update(hashes.tobytes())
    return f"{place}-{digest.hexdigest()}"


def shared(
    rows: DataFrame,
    hashes_of: Callable[[], Callable[[pa.Table], Hashes]],
    listed: bool = False,
    often: int = 1 << 62,
    block_bytes: int = base.BLOCK_BYTES,
    total_bytes: int | None = None,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """For rows of id and text (or another column): the id, a key, how many hashes the text
    has, how many of them occur more than once in the table, and these if they are
    ``listed``, from rare to frequent.

    ``hashes_of`` makes, once a task, the function that gives keys and hashes of a block of
    rows. ``rows`` should come from a table, whose order lasts if a task is run again. The
    number of buckets follows ``total_bytes``, which are counted unless they are given.
    """
    column = next(name for name in rows.columns if name != "id")
    total = bytes_of(rows, column) if total_bytes is None else total_bytes
    buckets = bucket_count(rows.sparkSession, total, bucket_bytes)

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_block = hashes_of()
        task = TaskContext.get().partitionId()
        limits = (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64)
        for block_no, block in enumerate(base.blocks(batches, column, block_bytes)):
            found = of_block(block)
            hashes = np.concatenate([h for _, h in found])
            lengths = np.array([len(h) for _, h in found], np.int64)
            owners = np.repeat(np.arange(len(found), dtype=np.uint32), lengths)
            ids = block.column("id").to_pylist()
            name = _block_name(f"{task}-{block_no}", ids, lengths, hashes)
            order = np.argsort(hashes)
            hashes, owners = hashes[order], owners[order]
            narrow = owners.astype(np.uint16) if len(found) < 1 << 16 else owners
            ends = np.concatenate([[0], np.searchsorted(hashes, limits), [len(hashes)]])
            out = []
            used = np.flatnonzero(np.diff(ends)).tolist() or [block_no % buckets]
            for bucket in used:
                part = slice(ends[bucket], ends[bucket + 1])
                out.append(
                    {
                        "bucket": bucket,
                        "block": name,
                        "parts": len(used),
                        "hashes": pack_sorted(hashes[part]),
                        "owners": narrow[part].tobytes(),
                        "ids": None if out else ids,
                        "keys": None if out else [key for key, _ in found],
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=arrow_schema(ASKED))

    def answer(asked: pa.Table) -> pa.Table:
        parts = asked.to_pylist()
        hashes = [unpack_sorted(p["hashes"]) for p in parts]
        counts = occurrences(np.concatenate(hashes))
        out, at = [], 0
        for p, own in zip(parts, hashes, strict=True):
            wide = len(p["owners"]) == 4 * len(own)
            owners = np.frombuffer(p["owners"], np.uint32 if wide else np.uint16)
            n = counts[at : at + len(own)]
            at += len(own)
            times = n[n > 1]
            bits = np.frexp(times.astype(np.float64))[1].astype(np.uint64)
            chosen = own[n > 1] | (bits << np.uint64(COUNT_SHIFT))
            chosen |= np.where(times > often, np.uint64(OFTEN), np.uint64(0))
            out.append(
                {
                    "block": p["block"],
                    "parts": p["parts"],
                    "totals": np.bincount(owners).astype(np.uint32).tobytes(),
                    "shared": np.bincount(owners[n > 1]).astype(np.uint32).tobytes(),
                    "listed": chosen.tobytes() if listed else b"",
                    "holders": owners[n > 1].astype(np.uint32).tobytes() if listed else b"",
                    "ids": p["ids"],
                    "keys": p["keys"],
                }
            )
        return pa.Table.from_pylist(out, schema=arrow_schema(ANSWERED))

    def merge(answers: pa.Table) -> pa.Table:
        parts = answers.to_pylist()
        if len(parts) != parts[0]["parts"]:
            raise RuntimeError(
                "a task that was run again met its rows in another order; write them to a table"
            )
        named = next(p for p in parts if p["ids"] is not None)
        n = len(named["ids"])
        sums = {name: np.zeros(n, np.int64) for name in ("totals", "shared")}
        for name, total in sums.items():
            for p in parts:
                counts = np.frombuffer(p[name], np.uint32)
                total[: len(counts)] += counts
        lists = pa.nulls(n, pa.list_(pa.int64()))
        if listed:
            hashes = np.concatenate([np.frombuffer(p["listed"], np.uint64) for p in parts])
            owners = np.concatenate([np.frombuffer(p["holders"], np.uint32) for p in parts])
            order = np.lexsort((hashes, owners))
            offsets = np.searchsorted(owners[order], np.arange(n + 1, dtype=np.uint32))
            lists = pa.ListArray.from_arrays(
                pa.array(offsets.astype(np.int32)), pa.array(hashes[order].view(np.int64))
            )
        return pa.table(
            [
                pa.array(named["ids"], pa.int64()), pa.array(named["keys"], pa.string()),
                pa.array(sums["totals"]), pa.array(sums["shared"]), lists,
            ],
            schema=arrow_schema(MERGED),
        )

    asked = rows.select(F.col("id").cast("bigint").alias("id"), column).mapInArrow(ask, ASKED)
    answered = asked.groupBy("bucket").applyInArrow(answer, ANSWERED)
    return answered.groupBy("block").applyInArrow(merge, MERGED)
