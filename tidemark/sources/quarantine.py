"""Good and bad lines of text files, told apart in one pass.

A file is read once. Every line is parsed and checked; typed rows and refused lines are written
to one table, in the order in which they come, with what is wrong and where the line stands. (Folders
of their own would make each task sort its lines by folder.) An observation counts them on the
way, so nothing is read again to say how many there are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text
from tidemark.sources import readers, scratch

#: Where a refused line stands, as ``readers.with_arrival`` tells it.
PLACE = ("_file", "_block", "_place")


@dataclass(frozen=True)
class Split:
    """``good`` has the typed columns; ``bad`` has ``reason``, ``line``, ``file``, ``block`` and
    ``place``; ``counts`` has the number of lines, of good ones, and of each reason met."""

    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def _split(
    lines: DataFrame, line: str, checks: Sequence[tuple[str, Column]], columns: Sequence[Column],
) -> Split:
    """Rows of lines, with a column for each of ``columns``. A check names what is wrong and
    says of which rows; the first that holds is the reason."""
    reason = F.coalesce(*[F.when(wrong, F.lit(name)) for name, wrong in checks])
    checked = lines.select(
        *columns,
        reason.alias("_reason"),
        F.col(line).alias("_line"),
        *[F.col(a).alias(b) for a, b in zip(readers.ARRIVAL, PLACE, strict=True)],
    )
    observed = Observation(f"lines-{uuid.uuid4().hex}")
    is_bad = F.col("_reason").isNotNull()
    watched = checked.observe(
        observed,
        F.count("*").alias("lines"),
        F.count(F.when(~is_bad, 1)).alias("good"),
        *[F.count(F.when(F.col("_reason") == name, 1)).alias(f"bad {name}") for name, _ in checks],
    )
    only_bad = [F.when(is_bad, F.col(name)).alias(name) for name in ("_line", *PLACE)]
    names = [name for name in watched.columns if not name.startswith("_")]
    table = scratch.written(
        watched.select(*names, "_reason", *only_bad, is_bad.alias("_bad")), "checked-lines"
    )
    counts = {
        name.removeprefix("bad "): n for name, n in observed.get.items()
        if n or not name.startswith("bad ")
    }
    bad = table.filter("_bad").select(
        F.col("_reason").alias("reason"), F.col("_line").alias("line"), F.col("_file").alias("file"),
        F.col("_block").alias("block"), F.col("_place").alias("place"),
    )
    return Split(table.filter("not _bad").select(*names), bad, counts)


def videos(spark: SparkSession, path: str, date_format: str = dates.DAY_MONTH_YEAR) -> Split:
    """Video lines. Refused are those with too few fields (``fields``), and those with a field
    that has a value which is none of its type (the field's name, the first of several).
    Header lines and lines without any text are neither good nor bad."""
    value = F.col("value")
    header = text.strip(value).startswith(f"{readers.VIDEO_FIELDS[0]},")
    lines = readers.with_arrival(spark.read.text(path))
    lines = lines.filter(~header & (text.strip(value) != ""))
    whole = text.has_fields(value, len(readers.VIDEO_FIELDS))
    fields = F.when(whole, text.fields(value))
    raw = lines.withColumn("_fields", fields)
    columns, checks = [], [("fields", F.col("_fields").isNull())]
    for place, name in enumerate(readers.VIDEO_FIELDS):
        field = F.get("_fields", F.lit(place))
        if name == "trending_date":
            typed = dates.parse_date(field, date_format)
        elif name in readers.VIDEO_TYPES:
            typed = F.trim(field).try_cast(readers.VIDEO_TYPES[name])
        else:
            columns.append(field.alias(name))
            continue
        columns.append(typed.alias(name))
        checks.append((name, (F.trim(field) != "") & typed.isNull()))
    return _split(raw, "value", checks, columns)


def ratings(spark: SparkSession, path: str) -> Split:
    """Rating lines. Refused are those that have not four fields (``fields``) and those whose
    rating is no number (``rating``)."""
    value = F.col("value")
    parts = F.split(value, ",")
    lines = readers.with_arrival(spark.read.text(path))
    rating = numbers.try_double(F.get(parts, F.lit(2)))
    checks = [("fields", ~value.rlike(readers.FOUR_FIELDS)), ("rating", rating.isNull())]
    columns = [F.get(parts, F.lit(1)).alias("movie_id"), rating.alias("rating")]
    return _split(lines, "value", checks, columns)


def movies(spark: SparkSession, path: str, genre_sep: str = "|") -> Split:
    """Movie lines. Refused are those with another number of fields (``fields``), which the
    file reader hands over as they are, and those without an id (``movie_id``)."""
    raw = (
        spark.read.schema(f"{readers.MOVIE_SCHEMA}, _corrupt string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("columnPruning", False)
        .option("escape", '"')
        .csv(path)
    )
    rows = readers.with_arrival(raw)
    genres = F.split(F.coalesce("genres", F.lit("")), f"\\Q{genre_sep}\\E")
    fields = F.concat_ws(",", "movie_id", "title", "genres")
    rows = rows.withColumn("_text", F.coalesce("_corrupt", fields))
    checks = [("fields", F.col("_corrupt").isNotNull()), ("movie_id", F.col("movie_id").isNull())]
    return _split(rows, "_text", checks, [F.col("movie_id"), F.col("title"), genres.alias("genres")])
