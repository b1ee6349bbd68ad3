"""Remove runs of lines that stand elsewhere in the corpus.

A document is cut into chunks of lines where a rolling hash over the hashes of the last few
lines is divisible by ``spacing``; a shared passage is therefore cut at the same lines wherever
it stands. Of every chunk of at least two lines that occurs more than once, the first stays
(smallest doc_id, then text digest, then place) and the others go, after their bytes have been
compared with the first. Only column functions are used.

A passage of a few lines inside otherwise different documents seldom holds a whole chunk. The
functions on runs cut nothing: every sequence of ``min_lines`` adjacent lines is compared with
all others, so each repeated run of at least that many lines is found, wherever it begins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources import scratch

#: Lines that the rolling hash covers, and one in how many lines ends a chunk.
ROLLING = 2
SPACING = 3
MIN_LINES = 2
FACTOR = 31
#: What names a document: rows that agree in both are one.
OWN = ["_rid", "_digest"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("bigint")


def chunk_ends(hashes: Column, rolling: int, spacing: int) -> Column:
    """The last lines of the chunks: where the rolling hash says, and the end of the text."""

    def ends(i: Column) -> Column:
        code = F.get(hashes, i)
        for back in range(1, rolling):
            code = code + FACTOR**back * F.coalesce(F.get(hashes, i - back), F.lit(0))
        return (code % spacing == 0) | (i == F.size(hashes) - 1)

    return F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), ends)


def chunks(
    text: Column, rolling: int = ROLLING, spacing: int = SPACING, min_lines: int = MIN_LINES
) -> Column:
    """First line, line after the last, and text of each chunk of enough lines."""

    def spans(lines: Column, ends: Column) -> Column:
        every = F.transform(
            ends,
            lambda end, k: let(
                F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1) + 1),
                lambda begin: F.struct(
                    begin.alias("begin"),
                    (end + 1).alias("end"),
                    F.array_join(F.slice(lines, begin + 1, end + 1 - begin), "\n").alias("text"),
                ),
            ),
        )
        return F.filter(every, lambda c: c["end"] - c["begin"] >= min_lines)

    return let(
        F.split(text, "\n"),
        lambda lines: let(
            F.transform(lines, line_hash),
            lambda hashes: let(
                chunk_ends(hashes, rolling, spacing), lambda ends: spans(lines, ends)
            ),
        ),
    )


def _laid_out(documents: DataFrame, *further: Column) -> DataFrame:
    """The rows, with further columns, in a table of their own, laid out by id and text."""
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = documents.columns
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = documents.select(
        *[documents[name].alias(f"c{i}") for i, name in enumerate(names)],
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("_rid"),
        F.md5(text.cast("binary")).alias("_digest"),
        *further,
    )
    table = scratch.bucketed(keyed, "lines", parts, OWN)
    stored = F.col(f"c{names.index('text')}").cast("string")
    return table.withColumn("_text", F.coalesce(stored, F.lit("")))


def _marked(documents: DataFrame, rolling: int, spacing: int, min_lines: int) -> DataFrame:
    """The rows, and in ``_gone`` the first and end lines of the chunks to remove. The rows are
    moved once, into a table laid out by id and text."""
    return _with_chunks(_laid_out(documents), rolling, spacing, min_lines)


def _with_chunks(table: DataFrame, rolling: int, spacing: int, min_lines: int) -> DataFrame:
    """Rows that are laid out, and their chunks to remove. Chunks are counted by a hash; only
    those that repeat are then read with their text and compared."""
    found = chunks(F.col("_text"), rolling, spacing, min_lines)
    several = F.col("_text").contains("\n")  # a chunk of a single line never goes
    listed = table.filter(several).select(*OWN, F.posexplode(found).alias("k", "chunk"))
    hashed = listed.select(*OWN, "k", F.xxhash64("chunk.text").alias("hash"))
    first = F.struct(*OWN, "k")
    repeated = scratch.written(
        hashed.groupBy("hash")
        .agg(F.min(first).alias("first"), F.max(first).alias("last"))
        .filter("first != last")
        .select("hash", "first"),
        "repeated-chunks",
    )
    marks = scratch.written(
        hashed.join(repeated, "hash")
        .groupBy(*OWN)
        .agg(
            F.collect_set(
                F.struct("k", "hash", (F.struct(*OWN, "k") == F.col("first")).alias("is_first"))
            ).alias("marks")
        ),
        "marked-chunks",
    )
    # all columns are read by name: a document's chunks again, only where some repeat
    compared = (
        table.join(marks, OWN)
        .select(*OWN, "marks", found.alias("chunks"))
        .select(*OWN, F.explode("marks").alias("mark"), "chunks")
        .select(*OWN, "mark.hash", "mark.is_first", F.get("chunks", F.col("mark.k")).alias("chunk"))
    )
    compared = scratch.written(compared, "compared-chunks")
    kept = compared.filter("is_first").groupBy("hash").agg(F.min("chunk.text").alias("kept"))
    gone = (
        compared.filter("not is_first")
        .join(kept, "hash")
        .filter(F.col("chunk.text") == F.col("kept"))
        .groupBy(*OWN)
        .agg(F.collect_set(F.struct("chunk.begin", "chunk.end")).alias("_gone"))
    )
    return table.join(scratch.written(gone, "removed-chunks"), OWN, "left")


def _kept_lines(text: Column, gone: Column) -> Column:
    """The lines of a text that no removed chunk covers."""
    return let(
        F.split(text, "\n"),
        lambda lines: F.when(gone.isNull(), lines).otherwise(
            F.filter(
                lines,
                lambda line, i: ~F.exists(gone, lambda g: (i >= g["begin"]) & (i < g["end"])),
            )
        ),
    )


def find(
    documents: DataFrame, rolling: int = ROLLING, spacing: int = SPACING, min_lines: int = MIN_LINES
) -> DataFrame:
    """Per row: doc_id, its lines, chunks and lines removed, and the SHA-256 of what is left.

    A NULL text has no lines; an empty one has one. Rows with equal doc_id and text are one
    document and lose the same lines. Rows without a doc_id come first in the order.
    """
    marked = _marked(documents.select("doc_id", "text"), rolling, spacing, min_lines)
    removed = F.aggregate(
        F.coalesce("_gone", F.expr("array()").cast("array<struct<begin:int,end:int>>")),
        F.lit(0),
        lambda total, g: total + g["end"] - g["begin"],
    )
    left = F.array_join(_kept_lines(F.col("_text"), F.col("_gone")), "\n")
    return marked.select(
        F.col("c0").cast("bigint").alias("doc_id"),
        F.when(F.col("c1").isNull(), 0)
        .otherwise(F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1)
        .cast("bigint")
        .alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_chunks_removed"),
        removed.cast("bigint").alias("n_lines_removed"),
        F.sha2(left.cast("binary"), 256).alias("kept_sha256"),
    )


def remove(
    documents: DataFrame, rolling: int = ROLLING, spacing: int = SPACING, min_lines: int = MIN_LINES
) -> DataFrame:
    """The rows with what is left of their texts, and n_chars, where it is a column, counted
    anew for texts that changed. Rows that lose all their lines keep an empty text."""
    marked = _marked(documents, rolling, spacing, min_lines)
    left = F.array_join(_kept_lines(F.col("_text"), F.col("_gone")), "\n")
    return _with_left(documents, marked, left)


def _with_left(
    documents: DataFrame, marked: DataFrame, left: Column, changed: Column | None = None
) -> DataFrame:
    """The columns of the rows, with what is left of texts that changed."""
    changed = F.col("_gone").isNotNull() if changed is None else changed
    cleaned = marked.withColumn("_left", F.when(changed, left))
    columns = []
    for i, field in enumerate(documents.schema.fields):
        column = F.col(f"c{i}")
        if field.name == "text":
            column = F.when(changed, F.col("_left")).otherwise(column)
        elif field.name == "n_chars":
            column = F.when(changed, F.length("_left")).otherwise(column).cast(field.dataType)
        columns.append(column.alias(field.name))
    return cleaned.select(*columns)


def _windows(lines: Column, min_lines: int) -> Column:
    """A hash for each ``min_lines`` adjacent lines, of lines that are at least as many."""
    return F.transform(
        F.sequence(F.lit(0), F.size(lines) - min_lines),
        lambda i: F.unhex(
            F.md5(F.array_join(F.slice(lines, i + 1, min_lines), "\n").cast("binary"))
        ),
    )


def _runs(repeats: Column, min_lines: int) -> Column:
    """From the sorted windows of a document that stand earlier, its runs: adjacent windows
    whose first places are adjacent too are one."""

    def adjacent(a: Column, b: Column) -> Column:
        return (
            (b["i"] == a["i"] + 1)
            & (b["first"]["i"] == a["first"]["i"] + 1)
            & (b["first"]["_rid"] == a["first"]["_rid"])
            & (b["first"]["_digest"] == a["first"]["_digest"])
        )

    starts = F.filter(
        F.transform(repeats, lambda mark, k: F.struct(k.alias("k"), mark.alias("mark"))),
        lambda s: (s["k"] == 0) | ~adjacent(F.get(repeats, s["k"] - 1), s["mark"]),
    )

    def last(found: Column, j: Column) -> Column:
        following = F.coalesce(F.get(found, j + 1)["k"], F.size(repeats))
        return F.get(repeats, following - 1)["i"]

    return let(
        starts,
        lambda found: F.transform(
            found,
            lambda s, j: F.struct(
                s["mark"]["i"].alias("begin"),
                (last(found, j) + min_lines).alias("end"),
                s["mark"]["first"].alias("first"),
            ),
        ),
    )


def _marked_runs(documents: DataFrame, min_lines: int) -> DataFrame:
    """The rows, and in ``_gone`` the numbers of the lines to remove. Texts are moved once."""
    return _with_runs(_laid_out(documents, F.monotonically_increasing_id().alias("_row")), min_lines)


def _with_runs(table: DataFrame, min_lines: int) -> DataFrame:
    """Rows that are laid out, and their lines to remove. Of texts with repeated runs, the runs
    are moved to the rows where they stand first and compared line by line."""
    if min_lines < 1:
        raise ValueError("min_lines must be at least 1")
    lines = F.split("_text", "\n")
    # one row of each document; `<=`, as an equality would be taken for a key of the join
    least = table.groupBy(*OWN).agg(F.min("_row").alias("_least"))
    single = table.join(least, OWN).filter("_row <= _least").select(*OWN, "_text")
    enough = table.filter(F.size(lines) >= min_lines)
    hashed = enough.select(
        *OWN, F.posexplode(let(lines, lambda x: _windows(x, min_lines))).alias("i", "hash")
    )
    place = F.struct(*OWN, "i")
    repeated = scratch.written(
        hashed.groupBy("hash")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first != last")
        .select("hash", "first"),
        "repeated-windows",
    )
    marks = scratch.written(
        hashed.join(repeated, "hash")
        .filter(place != F.col("first"))
        .select(*OWN, F.struct("i", "first").alias("m"))
        .groupBy(*OWN)
        .agg(F.array_sort(F.collect_set("m")).alias("repeats"))
        .select(*OWN, _runs(F.col("repeats"), min_lines).alias("runs")),
        "marked-runs",
    )
    pieces = scratch.written(
        single.join(marks, OWN)
        .select(*OWN, lines.alias("lines"), F.explode("runs").alias("run"))
        .select(
            *OWN, "run.begin", "run.end",
            F.col("run.first._rid").alias("first_rid"),
            F.col("run.first._digest").alias("first_digest"),
            F.col("run.first.i").alias("first_begin"),
            F.slice("lines", F.col("run.begin") + 1, F.col("run.end") - F.col("run.begin"))
            .alias("lines"),
        ),
        "repeated-runs",
    )
    # a first place may be asked for by very many rows: its lines are read once for each of its
    # different runs, and a hot run is a key that the skew join splits
    named = ["first_rid", "first_digest", "first_begin", "length"]
    sized = pieces.withColumn("length", F.col("end") - F.col("begin"))
    wanted = sized.select(*named).distinct()
    originals = scratch.written(
        single.select(F.col("_rid").alias("first_rid"), F.col("_digest").alias("first_digest"), "_text")
        .join(wanted, ["first_rid", "first_digest"])
        .select(*named, F.slice(lines, F.col("first_begin") + 1, F.col("length")).alias("original")),
        "first-runs",
    )
    same = sized.join(originals, named).filter(F.col("lines") == F.col("original"))
    numbers = F.flatten(F.collect_set(F.sequence("begin", F.col("end") - 1)))
    gone = same.groupBy(*OWN).agg(F.array_distinct(numbers).alias("_gone"))
    return table.join(scratch.written(gone, "removed-lines"), OWN, "left")


def _left_over(text: Column, gone: Column) -> Column:
    """The text without the lines of the given numbers."""
    return let(
        F.split(text, "\n"),
        lambda lines: F.array_join(
            F.when(gone.isNull(), lines).otherwise(
                F.transform(
                    F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone),
                    lambda i: F.get(lines, i),
                )
            ),
            "\n",
        ),
    )


def find_runs(documents: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """Per row: doc_id, its lines, those that go, and the SHA-256 of what is left.

    A line goes if it lies in a sequence of ``min_lines`` adjacent lines that stands earlier
    (smaller doc_id, then text digest, then line). It is then still left at an earlier place;
    where repeated runs overlap, their lines may be left in different documents. Lines are
    compared as they are, also blank ones. NULLs and repeated rows are treated as ``find``
    treats them.
    """
    marked = _marked_runs(documents.select("doc_id", "text"), min_lines)
    return marked.select(
        F.col("c0").cast("bigint").alias("doc_id"),
        F.when(F.col("c1").isNull(), 0).otherwise(F.size(F.split("_text", "\n")))
        .cast("bigint")
        .alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_lines_removed"),
        F.sha2(_left_over(F.col("_text"), F.col("_gone")).cast("binary"), 256).alias("kept_sha256"),
    )


def remove_runs(documents: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """The rows without the lines that ``find_runs`` counts; columns as ``remove`` gives them."""
    marked = _marked_runs(documents, min_lines)
    return _with_left(documents, marked, _left_over(F.col("_text"), F.col("_gone")))


def remove_repeats(
    documents: DataFrame, rolling: int = ROLLING, spacing: int = SPACING, min_lines: int = MIN_LINES
) -> DataFrame:
    """The rows without repeated chunks, and then without the repeated runs of lines in which
    no whole chunk lies: what ``remove`` and ``remove_runs`` do, on one layout of the rows.
    Where rows share a doc_id, the digest of the text as it came tells them apart in both."""
    table = _laid_out(documents, F.monotonically_increasing_id().alias("_row"))
    first = _with_chunks(table, rolling, spacing, min_lines)
    kept = F.array_join(_kept_lines(F.col("_text"), F.col("_gone")), "\n")
    without_chunks = first.withColumn("_cut", F.col("_gone").isNotNull()).withColumn(
        "_text", F.when(F.col("_cut"), kept).otherwise(F.col("_text"))
    )
    marked = _with_runs(without_chunks.drop("_gone"), min_lines)
    left = _left_over(F.col("_text"), F.col("_gone"))
    return _with_left(documents, marked, left, F.col("_cut") | F.col("_gone").isNotNull())
