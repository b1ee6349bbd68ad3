"""Gzip files of several members, read and written by many tasks.

A gzip file may hold several members after each other (`pigz -i`, joined log files, or what
``write_lines`` makes). Nothing in a file says where they begin, so tasks look for them: each
takes a stretch of a file, tries every place that looks like a member's header and follows
members, whose checksums must hold, from end to start until the stretch is left. What a task
followed is a run. A stored member may itself hold the bytes of a whole gzip file; such a run
begins inside another one and is dropped. The runs left must follow each other without a gap.

Runs are what the data source ``gzip_lines`` reads, a task each. A line belongs to the run in
which it begins: a reader that starts within a line skips its rest, and one whose last line
is not ended reads on. Files of a single member are a run of their own, read by one task.

Files are opened with pyarrow's file systems (local or mounted, s3, gs, hdfs …) under the
paths that Spark lists.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from tidemark.sources import scratch

#: Bytes of a file in which a task looks for members, and of a member that is written.
STRETCH_BYTES = 64 << 20
MEMBER_BYTES = 1 << 20
#: Bytes that are read, and lines that are handed over, at a time.
READ_BYTES = 1 << 20
LINES = 8192
# Fixed value: how a member begins (two magic bytes, the deflate method).
HEADER = b"\x1f\x8b\x08"
#: Lists the files of a write in the order of their parts; readers of folders leave it out.
MANIFEST = "_manifest.json"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path; Spark writes ``file:/x`` where others write ``file:///x``."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


class _Member:
    """Reads one member from a place on: its bytes in pieces, then ``end``."""

    def __init__(self, file, start: int):
        self.file, self.start, self.end = file, start, None

    def pieces(self) -> Iterator[bytes]:
        """Raises zlib.error for what is no member, also where its checksum fails."""
        inflate = zlib.decompressobj(31)
        at = self.start
        self.file.seek(at)
        while not inflate.eof:
            read = self.file.read(READ_BYTES)
            at += len(read)
            piece = inflate.decompress(read, READ_BYTES)
            if not read and not piece and not inflate.eof:
                raise zlib.error("the file ends within a member")
            while True:
                if piece:
                    yield piece
                if inflate.eof or not inflate.unconsumed_tail:
                    break
                piece = inflate.decompress(inflate.unconsumed_tail, READ_BYTES)
        self.end = at - len(inflate.unused_data)


def _next_header(file, at: int, limit: int) -> int | None:
    """The next place before the limit that looks like a member's header."""
    while at < limit:
        file.seek(at)
        read = file.read(min(READ_BYTES, limit - at + len(HEADER) - 1))
        place = read.find(HEADER)
        if place >= 0:
            return at + place if at + place < limit else None
        if len(read) < len(HEADER):
            return None
        at += len(read) - len(HEADER) + 1
    return None


def runs_of(file, begin: int, end: int) -> Iterator[tuple[int, int, int | None]]:
    """Start, end and last byte of the text (None for no text) of each run of members that
    starts within the stretch."""
    at, run = begin, None
    while (start := _next_header(file, at, end)) is not None:
        member, last = _Member(file, start), None
        try:
            for piece in member.pieces():
                last = piece[-1]
        except zlib.error:
            at = start + 1
            continue
        if run and run[1] == start:
            run = (run[0], member.end, run[2] if last is None else last)
        else:
            if run:
                yield run
            run = (start, member.end, last)
        at = member.end
    if run:
        yield run


def find_runs(spark: SparkSession, path: str, stretch_bytes: int = STRETCH_BYTES) -> DataFrame:
    """The runs of the files under a path, as a written table: path, start, end, and whether
    a line begins at the start. Bytes that belong to no member fail the job."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    begins = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)),
                        F.lit(stretch_bytes).cast("bigint"))
    stretches = files.select("path", "length", F.explode(begins).alias("begin"))

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, name = _opened(row["path"])
                stop = min(row["begin"] + stretch_bytes, row["length"])
                with system.open_input_file(name) as file:
                    found = list(runs_of(file, row["begin"], stop))
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": pa.array([row["path"]] * len(found), pa.string()),
                        "length": pa.array([row["length"]] * len(found), pa.int64()),
                        "start": pa.array([r[0] for r in found], pa.int64()),
                        "end": pa.array([r[1] for r in found], pa.int64()),
                        "last": pa.array([r[2] for r in found], pa.int32()),
                    }
                )

    kinds = "path string, length bigint, start bigint, end bigint, last int"
    # a stretch is a row of a few bytes and much work: a task for each
    spread = stretches.repartition(max(1, stretches.count()))
    found = scratch.written(spread.mapInArrow(look, kinds), "gzip-runs")
    before = Window.partitionBy("path").orderBy("start")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    kept = found.withColumn("reached", F.coalesce(F.max("end").over(earlier), F.lit(0))).filter(
        F.col("start") >= F.col("reached")
    )
    last = F.last("last", ignorenulls=True).over(earlier)
    checked = scratch.written(
        kept.withColumn("line", F.coalesce(last == ord("\n"), F.lit(True))), "gzip-runs"
    )
    reached = checked.groupBy("path").agg(
        F.max("end").alias("reached"), F.max(F.col("start") > F.col("reached")).alias("gap")
    )
    bad = files.join(reached, "path", "left").filter(
        (F.col("length") > 0) & (F.coalesce("reached", F.lit(-1)) != F.col("length"))
        | F.coalesce("gap", F.lit(False))
    )
    if fault := bad.first():
        raise ValueError(f"{fault['path']} has bytes that belong to no gzip member")
    return checked.select("path", "start", "end", "line")


@dataclass
class Run(InputPartition):
    path: str
    start: int
    end: int
    line: bool


def _text_from(file, run: Run) -> Iterator[tuple[bytes, bool]]:
    """Pieces of text from the run's start to the file's end, and whether they are the run's."""
    file.seek(0, 2)
    size, at = file.tell(), run.start
    while at < size:
        member = _Member(file, at)
        for piece in member.pieces():
            yield piece, at < run.end
        at = member.end


def lines_of(file, run: Run) -> Iterator[bytes]:
    """The lines that begin in a run, without their ends (a newline, or a carriage return and
    a newline). What follows the last newline is a line, unless it is empty."""
    held: list[bytes] = []  # pieces of a line that is not ended
    skipping = not run.line
    for piece, own in _text_from(file, run):
        if not own and not held:
            break  # the next run begins with a line
        parts = piece.split(b"\n")
        if not own:
            # the rest of the last line, which may be longer than a piece
            held.append(parts[0])
            if len(parts) > 1:
                break
            continue
        for part in parts[:-1]:
            line = b"".join([*held, part])
            held = []
            if skipping:
                skipping = False
            else:
                yield line.removesuffix(b"\r")
        if skipping:
            held = []
        elif parts[-1]:
            held.append(parts[-1])
    if held and not skipping:
        yield b"".join(held).removesuffix(b"\r")


def as_text(lines: list[bytes]) -> pa.Array:
    """UTF-8, with replacement characters for what is none."""
    try:
        return pa.array(lines, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.runs, self.header = options["runs"], options.get("header")

    def partitions(self) -> list[Run]:
        system, path = _opened(self.runs)
        table = pa.dataset.dataset(path, filesystem=system, format="parquet").to_table()
        return [Run(**row) for row in table.to_pylist()]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        system, name = _opened(partition.path)
        with system.open_input_file(name) as file:
            lines = lines_of(file, partition)
            if self.header is not None and partition.start == 0:
                first = next(lines, b"").decode("utf-8", "replace")
                if first != self.header:
                    raise ValueError(f"{partition.path} has another header: {first}")
            number, kept = 0, []

            def batch() -> pa.RecordBatch:
                n = len(kept)
                return pa.RecordBatch.from_arrays(
                    [
                        as_text(kept),
                        pa.array([partition.path] * n, pa.string()),
                        pa.array([partition.start] * n, pa.int64()),
                        pa.array(range(number, number + n), pa.int64()),
                    ],
                    ["value", "path", "start", "number"],
                )

            for line in lines:
                kept.append(line)
                if len(kept) == LINES:
                    yield batch()
                    number, kept = number + LINES, []
            if kept:
                yield batch()


@dataclass
class _Part(WriterCommitMessage):
    """A task's file (None for no rows), its lines, and the first and last of them."""

    name: str | None
    part: int
    rows: int
    first: str | None
    last: str | None


class _Writer(DataSourceArrowWriter):
    """A file per task, written under a name of its own and given its place at the end."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.header = options.get("header")
        self.member_bytes = int(options.get("member_bytes", MEMBER_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Part:
        system, path = _opened(self.path)
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{uuid.uuid4().hex}.gz"
        system.create_dir(f"{path}/_unfinished", recursive=True)
        begun = b"" if self.header is None else self.header.encode() + b"\n"
        held, size, rows, first, value = [begun], len(begun), 0, None, None
        # pyarrow would compress what is written under this name once more
        with system.open_output_stream(f"{path}/_unfinished/{name}", compression=None) as file:

            def close() -> None:
                deflate = zlib.compressobj(wbits=31)
                file.write(deflate.compress(b"".join(held)) + deflate.flush())

            for batch in iterator:
                for value in batch.column(0).to_pylist():
                    first = value if not rows else first
                    line = (value or "").encode() + b"\n"
                    while size + len(line) > self.member_bytes:  # members end anywhere
                        room = max(self.member_bytes - size, 1)
                        held.append(line[:room])
                        close()
                        held, size, line = [], 0, line[room:]
                    held.append(line)
                    size, rows = size + len(line), rows + 1
            close()
        return _Part(name if rows else None, part, rows, first, value)

    def commit(self, messages: list[_Part | None]) -> None:
        system, path = _opened(self.path)
        found = sorted((m for m in messages if m and m.name), key=lambda m: m.part)
        for message in found:
            system.move(f"{path}/_unfinished/{message.name}", f"{path}/{message.name}")
        if found:
            system.delete_dir(f"{path}/_unfinished")
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{MANIFEST}", compression=None) as file:
            for m in found:
                row = {"file": m.name, "rows": m.rows, "first": m.first, "last": m.last}
                file.write(json.dumps(row).encode() + b"\n")

    def abort(self, messages: list[_Part | None]) -> None:
        system, path = _opened(self.path)
        if system.get_file_info(f"{path}/_unfinished").type != fs.FileType.NotFound:
            system.delete_dir(f"{path}/_unfinished")


class GzipLines(DataSource):
    """Options of a read: ``runs``, the path of a table that ``find_runs`` made, and
    ``header``, the line with which each file must begin and which is left out. Options of a
    write: ``path``, ``header``, and ``member_bytes``, the text of a member at most."""

    @classmethod
    def name(cls) -> str:
        return "gzip_lines"

    def schema(self) -> str:
        return "value string, path string, start bigint, number bigint"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)


def read_lines(
    spark: SparkSession, path: str, header: str | None = None, stretch_bytes: int = STRETCH_BYTES
) -> DataFrame:
    """The lines of gzip files: ``value``, and where it stands: the file's ``path``, the
    ``start`` of its run and its ``number`` in it, which order the lines of a file.

    The files are read twice, once to find the runs. A run is a task: about a file's size over
    ``stretch_bytes`` of them, if its members are shorter than that.
    """
    runs = scratch.scratch_path(spark, "gzip-runs")
    find_runs(spark, path, stretch_bytes).coalesce(1).write.parquet(runs)
    spark.dataSource.register(GzipLines)
    reader = spark.read.format("gzip_lines").option("runs", runs)
    return (reader if header is None else reader.option("header", header)).load()


def write_lines(
    lines: DataFrame, path: str, header: str | None = None, member_bytes: int = MEMBER_BYTES
) -> None:
    """Write a text column as gzip files of several members, a file for each task that has
    rows, and a manifest of them. NULL is an empty line."""
    lines.sparkSession.dataSource.register(GzipLines)
    writer = lines.write.format("gzip_lines").mode("append").option("member_bytes", member_bytes)
    if header is not None:
        writer = writer.option("header", header)
    writer.save(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_lines`` wrote under a path: ``file``, its number in the order of the parts,
    ``rows``, and the first and last line."""
    system, name = _opened(path)
    with system.open_input_file(f"{name.rstrip('/')}/{MANIFEST}") as file:
        rows = [json.loads(line) for line in file.read().splitlines()]
    listed = [(i, r["file"], r["rows"], r["first"], r["last"]) for i, r in enumerate(rows)]
    kinds = "number int, file string, rows bigint, first string, last string"
    return spark.createDataFrame(listed, kinds)
