"""Writers for results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources import gzip_members


def write_text(
    df: DataFrame, path: str, sep: str = "\t", parts: int | None = None, key: str | None = None
) -> None:
    """Delimited text, one line per row.

    ``parts`` fixes the number of part files; with ``key`` rows of a key share one, so give
    a key only to results that are small per key.
    """
    if parts and key:
        df = df.repartition(parts, key)
    elif parts:
        df = df.repartition(parts)
    df.write.option("sep", sep).csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)


def write_ordered(
    df: DataFrame, path: str, order: Sequence[str | Column], parts: int, sep: str = "\t",
    member_bytes: int = gzip_members.MEMBER_BYTES,
) -> None:
    """Delimited text in at most ``parts`` gzip files, in one order over all of them: the rows
    of a file come before those of the next one by name. ``gzip_members.manifest`` tells what
    each of them holds.

    Ranges are cut by the order and by the rows' own numbers, so rows that are equal in the
    order, however many, are dealt to several files; among them any order is right.
    """
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(parts, *order, "_salt")
    ordered = ranged.sortWithinPartitions(*order, "_salt")
    line = F.to_csv(F.struct(*df.columns), {"sep": sep})
    gzip_members.write_lines(ordered.select(line.alias("value")), path, None, member_bytes)
