"""Align the tokens of two tokenizers on the same texts, and count which ids go together.

Both tokenizers' tokens are byte strings that join to the text (with a space before it), so
the places where tokens of both end cut either list of ids into groups that cover the same
bytes. Ends are kept in a dictionary from end to index on either side; the sorted intersection
of its keys gives the slices. A link is a pair of tokens that end together.

A task turns a block of about a megabyte of text into one row: its documents' columns, the
distinct id pairs of its links with their counts, and the links as numbers of those pairs.
Only the distinct pairs of blocks are shuffled to be counted over the corpus, and only
their counts come back to the block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base
from tidemark.llm.byte_bpe import Encoder
from tidemark.sources import scratch

#: Bytes of text in a block, which becomes one row of about as many.
BLOCK_BYTES = 1 << 20
#: A pair's code is A's id times this, plus B's id.
SHIFT = 1 << 32
BLOCK = (
    "doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "groups_sha256 array<string>, n_links array<bigint>, links binary, pairs array<bigint>, "
    "counts array<bigint>"
)
RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)
LONGS = pa.list_(pa.int64())


class Pieces:
    """A sentencepiece model with byte fallback."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes[i] = bytes([int(piece[3:5], 16)])  # <0xHH>
            else:
                self.bytes[i] = piece.replace("\u2581", " ").encode()

    def ids(self, text: str) -> np.ndarray:
        return self.model.encode_as_numpy(text)


class Vocabulary:
    """The bytes of ids, their numbers of bytes, and the ids in writing."""

    def __init__(self, tokens: dict[int, bytes], end: str):
        every = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.bytes = np.array(every, object)
        self.sizes = np.array([len(token) for token in every], np.int64)
        #: Each id in writing, with what follows it within and at the end of a group.
        self.within = np.array([f"{i}," for i in range(len(every))], object)
        self.ending = np.array([f"{i}{end}" for i in range(len(every))], object)
        self.empty = not all(tokens.values())

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes[ids].tolist())


@lru_cache(maxsize=1)
def _tokenizers(path_a: str, path_b: str) -> tuple[Encoder, Pieces]:
    return Encoder(path_a, plain=True), Pieces(path_b)


def _ends(ids: np.ndarray, sizes: np.ndarray) -> dict[int, int]:
    """From the byte offset at which tokens end to the index after the last of them."""
    return dict(zip(np.cumsum(sizes[ids]).tolist(), range(1, len(ids) + 1), strict=True))


def slices(ends_a: dict[int, int], ends_b: dict[int, int]) -> tuple[list[int], list[int]]:
    """The end index in A and in B of each group; the next group begins there."""
    common = list(filter(ends_b.__contains__, ends_a))  # ascending, as the ends are
    return list(map(ends_a.__getitem__, common)), list(map(ends_b.__getitem__, common))


def _ending(ids: list[int], first: int, end: int, sizes) -> list[int]:
    """The tokens of a group that end where it ends: its last, and before it those after which
    only tokens without bytes follow."""
    at = end - 1
    while at > first and sizes[ids[at]] == 0:
        at -= 1
    return ids[at:end]


class Aligner:
    """Groups and links of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = _tokenizers(path_a, path_b)
        self.own_a, self.own_b = Vocabulary(self.a.bytes, "|"), Vocabulary(self.b.bytes, ";")

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides; none for a text that either side does not give back. Merges of
        bytes give back every text, so of A only the number of bytes is compared."""
        if text:
            spaced = " " + text
            a, b, raw = self.a.array(spaced), self.b.ids(text), spaced.encode()
            if self.own_a.sizes[a].sum() == len(raw) and self.own_b.joined(b) == raw:
                return a, b
        none = np.zeros(0, np.int64)
        return none, none

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
        return slices(_ends(a, self.own_a.sizes), _ends(b, self.own_b.sizes))

    def written(self, a: np.ndarray, b: np.ndarray, groups: tuple[list[int], list[int]]) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        out = np.empty(len(a) + len(b), object)
        ends_a, ends_b = (np.array(ends, np.int64) for ends in groups)
        for own, ids, ends, other in (
            (self.own_a, a, ends_a, np.concatenate([[0], ends_b[:-1]])),
            (self.own_b, b, ends_b, ends_a),
        ):
            # a group's ids stand after all ids of the other side that come before them
            at = np.arange(len(ids)) + np.repeat(other, np.diff(ends, prepend=0))
            out[at] = own.within[ids]
            out[at[ends - 1]] = own.ending[ids[ends - 1]]
        return "".join(out.tolist())[:-1]

    def links(
        self, a: np.ndarray, b: np.ndarray, groups: tuple[list[int], list[int]]
    ) -> np.ndarray:
        """The code of every pair of tokens that end together: of each group the last ones,
        and those before tokens without bytes, where a vocabulary has such."""
        if self.own_a.empty or self.own_b.empty:
            codes, i, k = [], 0, 0
            for j, m in zip(*groups, strict=True):
                codes += [
                    x * SHIFT + y
                    for x in _ending(a.tolist(), i, j, self.own_a.sizes)
                    for y in _ending(b.tolist(), k, m, self.own_b.sizes)
                ]
                i, k = j, m
            return np.array(codes, np.int64)
        ends_a, ends_b = (np.array(ends, np.int64) - 1 for ends in groups)
        return a[ends_a].astype(np.int64) * SHIFT + b[ends_b]


def _narrow(pairs: int) -> type:
    """The numbers of so many pairs need no more."""
    return np.uint16 if pairs <= 1 << 16 else np.uint32


def _block(aligner: Aligner, ids: list, texts: Iterable[str | None]) -> dict:
    out: dict[str, list] = {
        name: [] for name in ("n_a", "n_b", "n_groups", "groups_sha256", "n_links")
    }
    codes = []
    for text in texts:
        a, b = aligner.tokens(text or "")
        groups = aligner.groups(a, b)
        own = aligner.links(a, b, groups)
        digest = ""
        if len(a):
            digest = hashlib.sha256(aligner.written(a, b, groups).encode()).hexdigest()
        values = (len(a), len(b), len(groups[0]), digest, len(own))
        for name, value in zip(out, values, strict=True):
            out[name].append(value)
        codes.append(own)
    pairs, links, counts = np.unique(
        np.concatenate(codes), return_inverse=True, return_counts=True
    )
    return {
        "doc_id": ids, **out, "links": links.astype(_narrow(len(pairs))).tobytes(),
        "pairs": pairs, "counts": counts,
    }


def blocks(
    documents: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """A row per block of documents, as a written table with the column ``block``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        kinds = [LONGS, LONGS, LONGS, LONGS, pa.list_(pa.string()), LONGS, pa.binary(), LONGS, LONGS]
        for rows in base.blocks(batches, limit=block_bytes):
            texts = (text.as_py() for text in chain(*rows.column("text").chunks))
            found = _block(aligner, rows.column("doc_id").to_pylist(), texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(found.values(), kinds, strict=True)], list(found)
            )

    made = documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, BLOCK)
    return scratch.written(made.withColumn("block", F.monotonically_increasing_id()), "blocks")


def counted(table: DataFrame) -> DataFrame:
    """Per pair of ids: how many links of the corpus it has, and whether no other pair with
    the same B id has more."""
    pairs = table.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    counts = pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    counts = scratch.written(counts, "pair-counts")
    b = (F.col("pair") % SHIFT).alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )


def pair_counts(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """a_id, b_id, n (links) and best of every pair of ids that some link holds."""
    found = counted(blocks(documents, path_a, path_b))
    return found.select(
        F.floor(F.col("pair") / SHIFT).alias("a_id"), (F.col("pair") % SHIFT).alias("b_id"),
        "n", "best",
    )


def align(
    documents: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per row: doc_id, tokens on either side, groups, links, links of the best pair of their B
    id, the sum of the links' counts, and the SHA-256 of the groups in writing.

    NULL and empty texts, and texts that the tokens of one side do not give back, have no
    tokens: zeros and an empty digest. Rows that repeat are counted one by one. The files are
    read on the executors, under the given paths.
    """
    table = blocks(documents, path_a, path_b, block_bytes)
    asked = table.select("block", F.explode("pairs").alias("pair"))
    answers = (
        asked.join(counted(table), "pair")
        .groupBy("block")
        .agg(F.array_sort(F.collect_list(F.struct("pair", "n", "best"))).alias("answers"))
    )

    def result(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c).slice(i, 1) for c in batch.schema.names}
                columns = {c: row[c].flatten() for c in (*names, "groups_sha256")}
                n = row["n"].flatten().to_numpy()
                links = np.frombuffer(row["links"][0].as_py(), _narrow(len(n)))
                best = row["best"].flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(columns["n_links"].to_numpy())
                sums = []
                for value in (best.astype(np.int64), n):
                    so_far = np.concatenate([[0], np.cumsum(value[links])])
                    sums.append(np.diff(so_far[np.concatenate([[0], ends])]))
                yield pa.RecordBatch.from_arrays(
                    [*[columns[c] for c in names], *map(pa.array, sums), columns["groups_sha256"]],
                    [*names, "n_best", "count_sum", "groups_sha256"],
                )

    found = table.drop("pairs", "counts").join(answers, "block", "left")
    none = F.array()
    return found.select(
        *[c for c in found.columns if c not in ("block", "answers")],
        F.coalesce("answers.n", none.cast("array<bigint>")).alias("n"),
        F.coalesce("answers.best", none.cast("array<boolean>")).alias("best"),
    ).mapInArrow(result, RESULT)
