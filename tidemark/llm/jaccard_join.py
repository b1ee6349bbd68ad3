"""Link documents by the Jaccard similarity of their word shingles, exactly.

1 - J is a metric, so pivots can divide the work: documents at a distance above r from each
other need not be compared, and the triangle inequality tells many such pairs from their
distances to a pivot. But most documents share nothing with most others and lie at distance
1 from any pivot, which separates nothing. So pivots are chosen where documents meet:

1. *Shared shingles.* A linked document shares at least the threshold of its shingles. They
   are counted over all documents; the others drop out, with nothing but their count kept.
2. *Pivots.* With shingles ordered from rare to frequent, linked documents meet in a shingle
   of their first few (prefix filter). Each such shingle elects the document with the
   smallest hash among those that have it as pivot. A pivot and all who elected it form its
   region; linked documents are in a region together.
   A region whose documents are all in a larger one is left out.
3. *Regions.* A region small enough is joined in one task: prefixes propose pairs, the
   distances to the pivot discard by the triangle inequality, and what is already connected
   is not compared again. A larger one gets several pivots; documents linked to a pivot are
   connected by that and need no comparison with each other. Each document goes to the nearest
   pivot (its Voronoi region) and to those not farther than the nearest plus r (the boundary),
   and the parts are joined in the same way. For a linked pair, the part of the one that is
   nearer to its pivot holds both. A region whose parts would compare more than half of its own
   pairs stays whole: it gets further pivots as long as these connect much, and is joined in
   pairs of blocks, without the pairs in which all is connected (near copies of one text).

Copies (equal word sequences) are one document throughout.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm import base, exchange, fitting
from tidemark.llm.components import components
from tidemark.sources import scratch

WORDS = 5
#: Percent of the union that linked documents share.
PERCENT = 75
#: Documents that are joined in one task.
LEAF = 4_096
PIVOTS = 16
#: Bits of the map that sorts out documents without candidates, at most (8 MB).
FILTER_BITS = 1 << 26
#: Odd constants of the shingle hash.
FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
     0xFF51AFD7ED558CCD], np.uint64
)


def tokens(text: bytes) -> list[bytes]:
    """A-Z lowered, cut at space and the characters 9 to 13."""
    return text.lower().split()


def word_numbers() -> fitting.Numbers:
    return fitting.Numbers(xxhash.xxh3_64_intdigest)


def shingles(words: list[bytes], numbers: fitting.Numbers, size: int = WORDS) -> np.ndarray:
    """Sorted hashes of the different shingles; of fewer words, the whole sequence is one."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    word = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    code = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for place in range(size):
            code += word[place : place + n] * FACTORS[place % 5] + np.uint64(place)
            code ^= code >> np.uint64(29)
        code *= FACTORS[4]
        code ^= code >> np.uint64(32)
    return np.unique(code)


def key(words: list[bytes]) -> str | None:
    """Names a word sequence; documents without words have no name."""
    return xxhash.xxh3_128_hexdigest(b" ".join(words)) if words else None


def counted(documents: DataFrame, size: int, block_bytes: int) -> DataFrame:
    """Per document its key, the number of its shingles, and of those that others have too."""

    def maker():
        numbers = word_numbers()

        def of_text(text: bytes) -> tuple[str | None, np.ndarray]:
            words = tokens(text)
            return key(words), shingles(words, numbers, size)

        return of_text

    rows = documents.select(F.col("doc_id").cast("bigint").alias("id"), "text")
    counts = exchange.shared(rows, exchange.of_texts(maker), block_bytes=block_bytes)
    return counts.select(
        F.col("id").alias("doc_id"), "key", F.col("n").alias("n_shingles"), "n_shared"
    )


def least_shared_by_larger(n, percent: int):
    """Of linked documents the larger one, of n shingles, shares at least so many."""
    return -(-percent * n // 100)


def least_shared_by_smaller(n, percent: int):
    return -(-2 * percent * n // (100 + percent))


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """Key, number of shingles and shingles of every text; of rows with a ``key``, of those
    that have it."""
    asked = "key" in texts.columns

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = word_numbers()
        for block in base.blocks(batches):
            keys, found = [], []
            wanted = block.column("key").to_pylist() if asked else [None] * block.num_rows
            for text, name in zip(base.texts_as_bytes(block), wanted, strict=True):
                words = tokens(text)
                own = key(words)
                if own is not None and (name is None or own == name):
                    keys.append(own)
                    found.append(shingles(words, numbers, size).view(np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(keys, pa.string()),
                    "n": pa.array([len(s) for s in found], pa.int32()),
                    "hashes": pa.array(found, pa.list_(pa.int64())),
                }
            )

    return texts.mapInArrow(sets, "key string, n int, hashes array<bigint>")


def maybe_in(rows: DataFrame, few: DataFrame, column: str, most_bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose value is among those of ``few``, a written table, and some others: a
    sieve to go before the join that tells them apart.

    One bit of a map stands for a value's hash; the map has sixteen bits or more for each value,
    up to ``most_bits`` (beyond, more rows pass), and is sent to all tasks in pieces of 4 kB.
    """
    wanted = max(16 * few.count(), 1 << 15)
    bits = min(1 << (wanted - 1).bit_length(), most_bits)

    def place() -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits)) + 1  # buckets and places count from 1

    pieces = few.groupBy(F.bitmap_bucket_number(place()).alias("_piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place())).alias("_map")
    )
    bit = F.bitmap_bit_position(place())
    byte = F.substring("_map", (bit / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1
    piece = F.bitmap_bucket_number(place())
    return (
        rows.withColumn("_piece", piece)
        .join(F.broadcast(pieces), "_piece")
        .filter(is_set)
        .select(*rows.columns)
    )


def candidates(documents: DataFrame, info: DataFrame, size: int, percent: int) -> DataFrame:
    """The shingle sets of documents that may be linked, one of each group of copies: node,
    key, n and the hashes. Nodes are numbered in the written table.

    A document is found again by its doc_id. Where rows share an id, or have none, all of
    them are read and their keys decide.
    """
    chosen = (
        info.filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"),
             F.max("n_shared").alias("shared"))
        .filter(F.col("shared") * 100 >= F.col("n") * percent)
        .select("doc_id", "key")
    )
    several = scratch.written(
        info.groupBy("doc_id").agg(F.count("*").alias("rows"))
        .filter("rows > 1 or doc_id is null").select("doc_id"),
        "shared-ids",
    )
    own = chosen.join(several, chosen["doc_id"].eqNullSafe(several["doc_id"]), "left_anti")
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    own = scratch.written(own, "candidates")
    # the others' texts are not moved to the join, but for the few that the filter lets through
    found = _sets(
        maybe_in(texts, own, "doc_id").join(own, "doc_id").select("key", "text"), size
    )
    if not several.isEmpty():
        vague = texts.join(several, texts["doc_id"].eqNullSafe(several["doc_id"]), "left_semi")
        sets = _sets(vague.select("text"), size).join(chosen.select("key"), "key", "left_semi")
        once = sets.groupBy("key").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes"))
        known = own.select("key")
        found = found.unionByName(once.join(known, "key", "left_anti"))
    return found.withColumn("node", F.monotonically_increasing_id())


def regions(sets: DataFrame, percent: int, block_bytes: int = base.BLOCK_BYTES) -> DataFrame:
    """Pairs of region (the pivot's node) and node. Linked nodes are in a region together.

    The order from rare to frequent is that of the listed hashes: by the bits that the count
    takes, then by the hash. Shingles that agree in the 48 bits listed may propose a region;
    they link nothing.
    """

    def maker():
        return lambda block: [(None, found) for found in _arrays(block)]

    rows = sets.select(F.col("node").alias("id"), "hashes")
    ranked = exchange.shared(rows, maker, listed=True, block_bytes=block_bytes)
    # shingles of one document alone are rarest: they come first and meet nobody
    alone = F.col("n") - F.col("n_shared")
    prefix = F.col("n") - least_shared_by_larger_sql("n", percent) + 1 - alone
    small = F.col("n") - least_shared_by_smaller_sql("n", percent) + 1 - alone
    first = (
        ranked.withColumn("prefix", prefix.cast("int"))
        .filter("prefix > 0")
        .select(
            F.col("id").alias("node"),
            small.alias("small"),
            F.posexplode(F.slice("shared", F.lit(1), F.col("prefix"))).alias("pos", "hash"),
        )
        .select("node", "hash", (F.col("pos") < F.col("small")).alias("small"))
    )
    first = scratch.written(first, "first-shingles")
    place = F.struct(F.xxhash64("node").alias("place"), "node")
    elected = (
        first.groupBy("hash")
        .agg(F.min(place)["node"].alias("region"), F.min("node").alias("least"),
             F.max("node").alias("most"), F.max("small").alias("any"))
        .filter("least != most and any")
        .select("hash", "region")
    )
    return first.join(elected, "hash").select("region", "node").distinct()


def without_parts(pairs: DataFrame) -> DataFrame:
    """The regions that do not lie within another one. ``pairs`` is a written table.

    If all nodes of a region have the same region as their largest and it is another one, that
    one holds them all. It stays itself, since it is the largest of some of its nodes.
    """
    sizes = pairs.groupBy("region").agg(F.count("*").alias("members"))
    largest = pairs.join(sizes, "region").groupBy("node").agg(
        F.max(F.struct("members", "region"))["region"].alias("largest")
    )
    of_region = pairs.join(largest, "node").groupBy("region").agg(
        F.min("largest").alias("least"), F.max("largest").alias("most")
    )
    inner = of_region.filter("least = most and least != region").select("region")
    return pairs.join(inner, "region", "left_anti")


def least_shared_by_larger_sql(n: str, percent: int):
    return F.ceil(F.col(n) * percent / 100).cast("int")


def least_shared_by_smaller_sql(n: str, percent: int):
    return F.ceil(F.col(n) * (2 * percent) / (100 + percent)).cast("int")


class Region:
    """Documents of a region as numbered shingles, from rare to frequent within the region."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.n = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets)
        _, number, count = np.unique(every, return_inverse=True, return_counts=True)
        rank = np.empty(len(count), np.int64)
        rank[np.argsort(count, kind="stable")] = np.arange(len(count))
        owner = np.repeat(np.arange(len(sets)), self.n)
        order = np.lexsort((rank[number], owner))
        self.owner, self.rank = owner, rank[number][order]
        self.starts = np.cumsum(self.n) - self.n
        self.marked = np.zeros(len(count), bool)

    def own(self, document: int) -> np.ndarray:
        return self.rank[self.starts[document] : self.starts[document] + self.n[document]]

    def overlaps(self, document: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections with the others."""
        self.marked[self.own(document)] = True
        lengths = self.n[others]
        ends = np.cumsum(lengths)
        flat = np.repeat(self.starts[others] - (ends - lengths), lengths) + np.arange(ends[-1])
        found = np.add.reduceat(self.marked[self.rank[flat]], ends - lengths, dtype=np.int64)
        self.marked[self.own(document)] = False
        return found

    def links(self, tied: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Links that connect what is connected in the region; further links between
        documents that are connected already are not looked for. Documents with the same
        label in ``tied`` are connected from the start; -1 is no label."""
        m = len(self.n)
        group = np.arange(m)
        if tied is not None:
            _, first, label = np.unique(tied, return_index=True, return_inverse=True)
            group = np.where(tied < 0, group, first[label])
        found = []

        def tie(a: int, b: int) -> None:
            if group[a] != group[b]:
                found.append((a, b))
                group[group == group[b]] = group[a]

        def linked(a: int, others: np.ndarray, shared: np.ndarray) -> np.ndarray:
            return 100 * shared >= self.percent * (self.n[a] + self.n[others] - shared)

        rest = np.arange(1, m)
        if not len(rest):
            return found
        shared = self.overlaps(0, rest)
        distance = np.concatenate([[0.0], 1 - shared / (self.n[0] + self.n[rest] - shared)])
        for b in rest[linked(0, rest, shared)]:
            tie(0, int(b))
        radius = 1 - self.percent / 100 + 1e-9
        prefix = self.n - least_shared_by_larger(self.n, self.percent) + 1
        inside = np.arange(len(self.rank)) - np.repeat(self.starts, self.n) < np.repeat(prefix, self.n)
        order = np.argsort(self.rank[inside], kind="stable")
        posted, holders = self.rank[inside][order], self.owner[inside][order]
        core = np.bincount(group).argmax()  # the members of this group look among the others only
        outside = group[holders] != core
        posted_outside, holders_outside = posted[outside], holders[outside]
        within = group == core
        small = self.n - least_shared_by_smaller(self.n, self.percent) + 1
        for a in np.argsort(self.n, kind="stable"):
            if (group == group[a]).all():
                break
            own = self.own(a)[: small[a]]
            at, of = (posted_outside, holders_outside) if within[a] else (posted, holders)
            low, high = np.searchsorted(at, own), np.searchsorted(at, own, "right")
            itself = 0 if within[a] else 1
            met = [of[i:j] for i, j in zip(low, high, strict=True) if j - i > itself]
            if not met:
                continue
            others = np.unique(np.concatenate(met))
            others = others[
                (self.n[others] >= self.n[a])
                & (self.percent * self.n[others] <= 100 * self.n[a])
                & (np.abs(distance[others] - distance[a]) <= radius)
                & (group[others] != group[a])
            ]
            if len(others):
                for b in others[linked(a, others, self.overlaps(a, others))]:
                    tie(int(a), int(b))
        return found


def _arrays(rows: pa.Table) -> list[np.ndarray]:
    column = rows.column("hashes").combine_chunks()
    values = column.values.to_numpy().view(np.uint64)
    offsets = column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _leaf(percent: int):
    def join(rows: pa.Table) -> pa.Table:
        nodes = rows.column("node").to_numpy()
        nodes, at = np.unique(nodes, return_index=True)  # blocks of a pair may overlap
        arrays = _arrays(rows)
        order = at[np.argsort(nodes != rows.column("pivot")[0].as_py(), kind="stable")]
        nodes = rows.column("node").to_numpy()[order]
        tied = pc.fill_null(rows.column("tied"), -1).to_numpy()[order]
        found = Region([arrays[i] for i in order], percent).links(tied)
        return pa.table(
            {
                "u": pa.array([int(nodes[a]) for a, _ in found], pa.int64()),
                "v": pa.array([int(nodes[b]) for _, b in found], pa.int64()),
            }
        )

    return join


#: Members of a region with equal ``tied`` are connected already by links that have been found.
MEMBERS = ["region", "pivot", "node", "tied"]
LINKS = "u bigint, v bigint"
MEASURED = "region string, node bigint, tied bigint, parts array<bigint>, near array<bigint>"


def _measured(large: DataFrame, own: DataFrame, pivots: int, leaf: int, percent: int) -> DataFrame:
    """For members of regions that are too large, which get new pivots: the pivots in whose parts
    a member is, and those it is linked to. Each task takes some of a region's members and all
    of its few pivots."""
    radius = 1 - percent / 100 + 1e-9
    sizes = large.groupBy("region").agg(F.ceil(F.count("*") / leaf).cast("int").alias("salts"))
    # what is connected to nothing yet comes first
    order = Window.partitionBy("region").orderBy(
        F.col("tied").isNotNull(), F.xxhash64("node", "region"), "node"
    )
    chosen = (
        large.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= pivots)
        .select("region", "node")
    )
    centres = (
        chosen.join(sizes, "region")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .join(own, "node")
        .select("region", "salt", "node", "n", "hashes")
        .toDF("region", "salt", "node", "n", "hashes")  # other columns than the members'
    )
    salt = F.pmod(F.xxhash64("node"), F.col("salts")).cast("int")
    spread = large.join(sizes, "region").withColumn("salt", salt).join(own, "node")

    def measure(members: pa.Table, centres: pa.Table) -> pa.Table:
        names, sets = centres.column("node").to_numpy(), _arrays(centres)
        order = np.argsort(names)
        names, sets = names[order], [sets[i] for i in order]
        found = {"parts": [], "near": []}
        if members.num_rows:
            joint = Region(sets + _arrays(members), percent)
            rest = np.arange(len(sets), len(joint.n))
            shared = np.stack([joint.overlaps(i, rest) for i in range(len(sets))])
            union = joint.n[: len(sets)][:, None] + joint.n[rest] - shared
            distance = 1 - shared / union
            found["parts"] = [names[c] for c in (distance <= distance.min(axis=0) + radius).T]
            found["near"] = [names[c] for c in (100 * shared >= percent * union).T]
        lists = {name: pa.array(value, pa.list_(pa.int64())) for name, value in found.items()}
        return pa.table({c: members.column(c) for c in ("region", "node", "tied")} | lists)

    return (
        spread.select("region", "salt", "node", "tied", "n", "hashes")
        .groupBy("region", "salt")
        .cogroup(centres.groupBy("region", "salt"))
        .applyInArrow(measure, MEASURED)
    )


def _roots(pairs: pa.Table) -> pa.Table:
    """For the labels of a region, of which some are connected: the least one of each group."""
    root: dict[int, int] = {}

    def find(label: int) -> int:
        while root.setdefault(label, label) != label:
            label = root[label]
        return label

    for a, b in zip(pairs.column("label").to_pylist(), pairs.column("other").to_pylist(), strict=True):
        low, high = sorted((find(a), find(b)))
        root[high] = low
    region = pairs.column("region")[0].as_py()
    return pa.table(
        {
            "region": pa.array([region] * len(root), pa.string()),
            "label": pa.array(list(root), pa.int64()),
            "root": pa.array([find(label) for label in root], pa.int64()),
        }
    )


def _tied(measured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members with what is connected now, and links that connect it."""
    labels = F.array_compact(F.concat("near", F.array("tied")))
    first = measured.withColumn("labels", labels).withColumn("label", F.get("labels", F.lit(0)))
    pairs = scratch.written(
        first.select("region", "label", "node", F.explode("labels").alias("other"))
        .groupBy("region", "label", "other")
        .agg(F.min("node").alias("node")),
        "region-labels",
    )
    root = pairs.groupBy("region").applyInArrow(_roots, "region string, label bigint, root bigint")
    members = first.join(root, ["region", "label"], "left").select(
        "region", "node", F.col("root").alias("tied"), "parts"
    )
    # a link for each member, and one for each two pivots that members connect
    first_near = measured.select("node", F.get("near", F.lit(0)).alias("v"))
    every_near = measured.select("region", "node", F.explode("near").alias("other"))
    of_pivots = every_near.join(pairs, ["region", "node", "other"]).select("node", "other")
    every = first_near.union(of_pivots).filter("node != v").distinct()
    return members, every.select(F.col("node").alias("u"), "v")


def _sizes(members: DataFrame, *names: str) -> DataFrame:
    """Per region or part how many members, the largest connected group, and ``rest``, how many
    are outside of it."""
    known = F.col("tied").isNotNull()
    return (
        members.groupBy(*names, "tied")
        .agg(F.count("*").alias("n"))
        .groupBy(*names)
        .agg(F.sum("n").alias("members"), F.max(F.when(known, F.struct("n", "tied"))).alias("core"))
        .select(
            *names, "members", F.col("core.tied").alias("core"),
            (F.col("members") - F.coalesce("core.n", F.lit(0))).alias("rest"),
        )
    )


def _pairs_left() -> Column:
    """Pairs of which not both are in the largest group, twice."""
    members, core = F.col("members").cast("double"), (F.col("members") - F.col("rest")).cast("double")
    return members * members - core * core


def _in_block_pairs(flat: DataFrame, sizes: DataFrame, leaf: int) -> DataFrame:
    """Members of regions that pivots do not divide, so that any two meet in a pair of blocks,
    other than two of the largest connected group."""
    rest, core = (
        F.ceil(2 * n / leaf).cast("int") for n in (F.col("rest"), F.col("members") - F.col("rest"))
    )
    paired = flat.join(sizes.filter("rest > 0"), "region").withColumns({"rests": rest, "cores": core})
    inside = F.coalesce(F.col("tied") == F.col("core"), F.lit(False))
    place = F.xxhash64("node")
    block = F.when(inside, F.col("rests") + F.pmod(place, F.col("cores"))).otherwise(
        F.pmod(place, F.col("rests"))
    )
    last = F.when(inside, F.col("rests")).otherwise(F.col("rests") + F.col("cores")) - 1
    return (
        paired.withColumn("block", block.cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .select(
            F.concat_ws(
                "#", "region", F.least("block", "other").cast("string"),
                F.greatest("block", "other").cast("string"),
            ).alias("region"),
            F.col("node").alias("pivot"), "node", "tied",
        )
    )


def links(
    sets: DataFrame, percent: int, leaf: int = LEAF, pivots: int = PIVOTS,
    block_bytes: int = base.BLOCK_BYTES,
) -> DataFrame:
    """Links that connect all that is connected: u and v, nodes of the sets.

    Regions are pairs of ids; the hashes join them where they are compared.
    """
    proposed = scratch.written(regions(sets, percent, block_bytes), "proposed-regions")
    pairs = scratch.written(without_parts(proposed), "regions")
    sizes = pairs.groupBy("region").agg(F.count("*").alias("members"))
    over = scratch.written(sizes.filter(F.col("members") > leaf).select("region"), "large-regions")
    named = pairs.select(
        F.col("region").cast("string").alias("region"), F.col("region").alias("pivot"), "node",
        F.lit(None).cast("bigint").alias("tied"),
    )

    def joined(members: DataFrame, own: DataFrame) -> DataFrame:
        rows = members.join(own, "node").select(*MEMBERS, "hashes")
        return rows.groupBy("region").applyInArrow(_leaf(percent), LINKS)

    own = sets.select("node", "n", "hashes")
    found = joined(named.join(over, named["pivot"] == over["region"], "left_anti"), own)
    if over.isEmpty():
        return found
    large = named.join(over, named["pivot"] == over["region"], "left_semi")
    large = scratch.written(large, "large-members")
    nodes = scratch.written(large.select("node").distinct(), "large-nodes")
    own = scratch.written(maybe_in(own, nodes, "node").join(nodes, "node"), "large-shingles")
    while not large.isEmpty():
        before = _sizes(large, "region").select("region", F.col("rest").alias("before"))
        measured = scratch.written(_measured(large, own, pivots, leaf, percent), "measured-regions")
        members, near = _tied(measured)
        members = scratch.written(members, "tied-regions")
        inside = members.select("region", "node", "tied", F.explode("parts").alias("pivot"))
        parts = scratch.written(_sizes(inside, "region", "pivot"), "region-parts")
        left = parts.groupBy("region").agg(F.sum(_pairs_left()).alias("left"))
        way = (
            F.when(2 * F.col("left") <= _pairs_left(), "parts")
            .when((F.col("rest") > leaf) & (F.col("rest") <= 0.8 * F.col("before")), "again")
            .otherwise("blocks")
        )
        ways = _sizes(members, "region").join(left, "region").join(before, "region")
        ways = scratch.written(ways.withColumn("way", way), "region-ways")

        def going(rows: DataFrame, way: str, ways: DataFrame = ways) -> DataFrame:
            return rows.join(ways.filter(F.col("way") == way).select("region"), "region", "left_semi")

        divided = going(inside, "parts").join(
            parts.filter("rest > 0").select("region", "pivot", F.col("members").alias("size")),
            ["region", "pivot"],
        )
        divided = scratch.written(
            divided.withColumn("region", F.concat_ws("/", "region", F.col("pivot").cast("string"))),
            "divided-regions",
        )
        blocks = _in_block_pairs(
            members, ways.filter("way = 'blocks'").select("region", "members", "core", "rest"), leaf
        )
        small = divided.filter(F.col("size") <= leaf).select(*MEMBERS)
        found = found.union(near).union(joined(small, own)).union(joined(blocks, own))
        again = going(members, "again").select("region", F.col("node").alias("pivot"), "node", "tied")
        large = divided.filter(F.col("size") > leaf).select(*MEMBERS).union(again)
        large = scratch.written(large, "large-members")
    return found


def _keyed_clusters(
    documents: DataFrame, size: int, percent: int, leaf: int, pivots: int, block_bytes: int
) -> DataFrame:
    """Per row: doc_id, key, n_shingles, component_id and the least key of its component."""
    info = scratch.written(counted(documents, size, block_bytes), "shingle-counts")
    sets = scratch.written(candidates(documents, info, size, percent), "shingles")
    found = scratch.written(links(sets, percent, leaf, pivots, block_bytes), "region-links")
    groups = components(found)
    first = scratch.written(
        info.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("first")),
        "first-copies",
    )
    named = sets.select("node", "key").join(groups, "node").join(first, "key")
    least = named.groupBy("component").agg(
        F.min("first").alias("least"), F.min("key").alias("least_key")
    )
    joined = named.join(least, "component").select("key", "least", "least_key")
    # as a table, so that the last join shuffles both sides and can split a key of many copies
    of_key = scratch.written(
        first.join(joined, "key", "left").select(
            "key", F.coalesce("least", "first").alias("component_id"),
            F.coalesce("least_key", "key").alias("least_key"),
        ),
        "components",
    )
    return info.join(of_key, "key", "left").select(
        "doc_id",
        "key",
        "n_shingles",
        F.when(F.col("key").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
        "least_key",
    )


def cluster(
    documents: DataFrame, size: int = WORDS, percent: int = PERCENT, leaf: int = LEAF,
    pivots: int = PIVOTS, block_bytes: int = base.BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; component_id is the smallest doc_id
    reachable by links.

    Rows without words (NULL or empty text) have no shingles and are their own component.
    Rows with equal words are linked; so are rows that repeat a doc_id with linked texts, each
    row having its own text's component. Rows without a doc_id are linked like others, but a
    NULL is not the smallest; a component without any other has NULL.
    """
    found = _keyed_clusters(documents, size, percent, leaf, pivots, block_bytes)
    return found.select("doc_id", "n_shingles", "component_id")


def _with_key(documents: DataFrame, name: str) -> DataFrame:
    """The rows with the key of their text."""
    kind = T.StructType([*documents.schema.fields, T.StructField(name, T.StringType())])
    arrow = to_arrow_schema(kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in base.blocks(batches):
            keys = pa.array([key(tokens(t)) for t in base.texts_as_bytes(block)], pa.string())
            columns = [block.column(i).combine_chunks() for i in range(block.num_columns)]
            cast = [c.cast(f.type) for c, f in zip([*columns, keys], arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(cast, schema=arrow)

    return documents.mapInArrow(run, kind)


def keep_one(
    documents: DataFrame, size: int = WORDS, percent: int = PERCENT, leaf: int = LEAF,
    pivots: int = PIVOTS, block_bytes: int = base.BLOCK_BYTES,
) -> DataFrame:
    """The rows of one document of each component: of the one whose doc_id names it, or of the
    one with the least key, where no document of the component has an id. Rows without words
    stay; so do all rows that repeat the id and the words of the document that stays, and with
    the naming id, linked rows of other words.
    """
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = scratch.written(
        _keyed_clusters(texts, size, percent, leaf, pivots, block_bytes)
        .filter("key is not null")
        .withColumn(
            "stays",
            F.when(F.col("component_id").isNull(), F.col("key") == F.col("least_key"))
            .otherwise(F.col("doc_id").eqNullSafe(F.col("component_id"))),
        )
        .select("doc_id", "key", "stays"),
        "decisions",
    )
    gone = found.filter("not stays").select(F.col("doc_id").alias("_gone"), "key").distinct()
    # ids whose rows share one decision need no look at their texts
    kept_too = found.filter("stays").select(F.col("doc_id").alias("_gone")).distinct()
    unclear = scratch.written(
        gone.join(kept_too, "_gone", "left_semi").union(gone.filter("_gone is null")), "unclear"
    )
    sure = gone.select("_gone").filter("_gone is not null").distinct()
    sure = sure.join(unclear.select("_gone"), "_gone", "left_anti")
    doc_id = documents["doc_id"].cast("bigint")
    kept = documents.join(sure, doc_id == sure["_gone"], "left_anti")
    if unclear.isEmpty():
        return kept
    ids = unclear.select(F.col("_gone").alias("_id")).distinct()
    name = f"key_{uuid.uuid4().hex}"
    rest = kept.join(ids, kept["doc_id"].cast("bigint").eqNullSafe(ids["_id"]), "left_semi")
    clear = kept.join(ids, kept["doc_id"].cast("bigint").eqNullSafe(ids["_id"]), "left_anti")
    keyed = _with_key(rest, name)
    decided = keyed.join(
        unclear,
        keyed["doc_id"].cast("bigint").eqNullSafe(unclear["_gone"]) & (keyed[name] == unclear["key"]),
        "left_anti",
    )
    return clear.unionByName(decided.drop(name))
