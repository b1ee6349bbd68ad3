"""Document fingerprints by SpotSigs.

Where a common word stands, the content words that follow it form a signature: the chain of
the anchor and the next ``CHAIN`` words that are no anchors. So that texts in other languages
than those of the common words have anchors too, one in ``SPACING`` of all other words is one,
by its hash. The beginning of a text is an anchor, so every text with a word has a signature. A fingerprint is the set of a text's
signatures, written as sorted 32-bit hashes in base64; texts without words have an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, fitting
from tidemark.sources import scratch

#: Common words of the four languages, the anchors.
ANCHORS = (
    "the of and to is in that",
    "der die und den das ist von",
    "de la le et les des que",
    "el los en un por las se",
)
CHAIN = 2
SPACING = 16
WORD = re.compile(r"\w+")
SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, n_signatures int"
)


def word_codes(anchors: Iterable[str] = ANCHORS) -> fitting.Numbers:
    """Hashes of words; those of anchors are odd, all others even."""
    common = {word for line in anchors for word in line.split()}

    def code(word: str) -> int:
        own = xxhash.xxh3_64_intdigest(word)
        return own & ~1 | (word in common or (own >> 1) % SPACING == 0)

    return fitting.Numbers(code)


def signatures(text: str, codes: fitting.Numbers) -> np.ndarray:
    """Sorted 32-bit hashes of the signatures of a text."""
    words = WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint32)
    code = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    anchor = (code & np.uint64(1)).astype(bool)
    content = np.append(code[~anchor], np.zeros(CHAIN, np.uint64))
    before = np.cumsum(~anchor)  # content words up to and with each word
    at = np.append([0], before[anchor])
    with np.errstate(over="ignore"):
        chain = np.append([np.uint64(0)], code[anchor])
        for step in range(CHAIN):
            chain = (chain ^ (chain >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            chain += content[np.minimum(at + step, len(content) - 1)]
        chain *= np.uint64(0xD6E8FEB86659FD93)
    return np.unique((chain >> np.uint64(32)).astype(np.uint32))


def written(found: np.ndarray) -> str:
    return base64.b64encode(found.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets; of two empty ones 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def in_order(documents: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows dealt to ranges of ids (``part``) and sorted, each range followed by the first
    row of the next (``tail``), the last by the first of all. Texts are moved once.

    Equal ids are ordered by text; rows without an id come first.
    """
    spark = documents.sparkSession
    tasks = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("place"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    shares = [i / (4 * tasks) for i in range(1, 4 * tasks)]
    limits = rows.agg(F.percentile_approx("place", shares, 100_000)).first()[0]
    limits = np.unique(np.array(limits or [], np.int64))

    @F.pandas_udf("int")
    def part_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, place.to_numpy(), "right").astype(np.int32))

    part = part_of("place") if len(limits) else F.lit(0)
    firsts = sorted(
        (row["part"], row["place"])
        for row in rows.select("place").groupBy(part.alias("part")).agg(
            F.min("place").alias("place")).collect()
    )  # one row per part
    owners = [(place, firsts[i - 1][0]) for i, (_, place) in enumerate(firsts)]
    tails = spark.createDataFrame(owners, "first bigint, part int")
    tail_rows = rows.join(F.broadcast(tails), rows["place"] == tails["first"]).select(
        "doc_id", "place", "text", "part", F.lit(1).alias("tail")
    )
    every = rows.select("doc_id", "place", "text", part.alias("part"), F.lit(0).alias("tail"))
    return (
        every.union(tail_rows)
        .repartition(tasks, "part")
        .sortWithinPartitions("part", "tail", "place", "text")
    )


def compare_with_next(documents: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited form, in which the last half of the code
    points gives way to as many from the beginning of the next document; and how like the
    fingerprint is to the edited text's and to the next document's."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = word_codes()
        last = None
        for block in base.blocks(batches):
            out = []
            columns = (block.column(c).to_pylist() for c in ("doc_id", "text", "part", "tail"))
            for doc_id, text, part, tail in zip(*columns, strict=True):
                own = signatures(text, codes)
                if last is not None and last[2] == part and not last[3]:
                    out.append(_compared(*last[:2], last[4], text, own, codes))
                last = (doc_id, text, part, tail, own)
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return in_order(documents, parts).mapInArrow(run, SCHEMA)


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
     ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_signatures", pa.int32())]
)


def _compared(doc_id, text: str, own: np.ndarray, following: str, other: np.ndarray, codes) -> dict:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    changed = signatures(edited, codes)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
        "fingerprint": written(own),
        "edited_fingerprint": written(changed),
        "near_edited": likeness(own, changed),
        "near_next": likeness(own, other),
        "n_signatures": len(own),
    }


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, and the signatures of each row's text as an array of numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = word_codes()
        for block in base.blocks(batches):
            texts = block.column("text").to_pylist()
            found = [signatures(t or "", codes).astype(np.int64) for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(block.column("doc_id").to_pylist(), pa.int64()),
                    "signatures": pa.array(found, pa.list_(pa.int64())),
                }
            )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, signatures array<bigint>")


def members(documents: DataFrame) -> DataFrame:
    """doc_id of every row whose text has a word, and ``class_doc_id``, the smallest doc_id with
    an equal fingerprint: with ``similar``, what each row is like. A class without any id has
    NULL."""
    own = fingerprints(documents).filter(F.size("signatures") > 0)
    # signatures are sorted and different, so their digest stands for the set
    keyed = own.select("doc_id", F.md5(F.array_join("signatures", ",")).alias("print"))
    least = keyed.groupBy("print").agg(F.min("doc_id").alias("class_doc_id"))
    # both sides shuffle, so that the adaptive skew join can split a class of very many copies
    return keyed.join(least.hint("shuffle_merge"), "print").select("doc_id", "class_doc_id")


def similar(documents: DataFrame, percent: int = 75) -> DataFrame:
    """Pairs of different fingerprints whose Jaccard similarity reaches the threshold: the
    smallest doc_id of each, which ``members`` gives for every row, and the similarity.

    Sets are partitioned by length so finely that a set's partners are in its own partition
    or the next. Within a partition they meet by their rarest signatures, as many as the
    threshold leaves unshared and one; a pair is dropped where its lengths rule it out, and
    is compared once, at the first signature at which it meets.
    """
    own = fingerprints(documents).filter(F.size("signatures") > 0)
    classes = scratch.written(
        own.groupBy("signatures").agg(F.min("doc_id").alias("doc_id"))
        .withColumn("n", F.size("signatures"))
        .withColumn("set_id", F.monotonically_increasing_id()),
        "fingerprints",
    )
    held = classes.select("set_id", "n", F.explode("signatures").alias("signature"))
    counts = held.groupBy("signature").agg(F.count("*").alias("df")).filter("df > 1")
    length = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))).cast("int")
    rare = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    first = (
        held.join(counts, "signature")
        .groupBy("set_id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "signature"))).alias("ranked"))
        .withColumn("rare", rare - (F.col("n") - F.size("ranked")))
        .filter("rare > 0")
        .select("set_id", "n", length.alias("part"), F.explode(F.slice("ranked", 1, F.col("rare"))).alias("r"))
        .select("set_id", "n", "part", F.col("r.signature").alias("signature"))
    )
    reach = first.select(
        F.col("set_id").alias("b"), F.col("n").alias("m"), "signature",
        F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"),
    )
    met = (
        first.join(reach, ["part", "signature"])
        .filter((F.col("set_id") != F.col("b")) & (F.col("m") >= F.col("n")))
        .filter((F.col("m") > F.col("n")) | (F.col("set_id") < F.col("b")))
        .filter(F.col("n") * 100 >= F.col("m") * percent)
        .select(F.col("set_id").alias("a"), "b")
        .distinct()
    )

    def side(name: str) -> DataFrame:
        return classes.select(
            F.col("set_id").alias(name), F.col("doc_id").alias(f"{name}_doc_id"),
            F.col("signatures").alias(f"{name}_set"),
        )

    shared = F.size(F.array_intersect("a_set", "b_set"))
    union: Column = F.size("a_set") + F.size("b_set") - shared
    return (
        met.join(side("a"), "a")
        .join(side("b"), "b")
        .select("a_doc_id", "b_doc_id", shared.alias("shared"), union.alias("union"))
        .filter(F.col("shared") * 100 >= F.col("union") * percent)
        .select("a_doc_id", "b_doc_id", (F.col("shared") / F.col("union")).alias("similarity"))
    )
