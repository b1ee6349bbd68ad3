"""Trending videos: countries per video, growth between the first two sightings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import folding


def video_countries(videos: DataFrame) -> DataFrame:
    """The (category, video, country) triples, one row each."""
    return videos.select("category", "video_id", "country").distinct()


def countries_per_video(videos: DataFrame) -> DataFrame:
    """Per category: in how many countries a video trends on average.

    Distinct triples are counted up in steps (triple, video, category), each with a
    map-side aggregate, so a huge category or video never sits in one task.
    """
    per_video = (
        video_countries(videos).groupBy("category", "video_id").agg(F.count("*").alias("n"))
    )
    return per_video.groupBy("category").agg(
        (F.sum("n") / F.count("*")).alias("countries_per_video")
    )


def countries_per_video_text(videos: DataFrame) -> DataFrame:
    return countries_per_video(videos).select(
        "category",
        numbers.two_decimals(F.col("countries_per_video")).alias("countries_per_video"),
    )


def sightings(videos: DataFrame, further: Sequence[str] = ()) -> DataFrame:
    """Key (video, country) and what was seen at a date."""
    return videos.select(
        "video_id", "country", "trending_date", "category", "likes", "dislikes", *further
    )


#: Sightings by date and then by everything else; those without a date come last.
BY_DATE = ("trending_date", "category", "likes", "dislikes")


def growth(videos: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """How much more the dislikes grew than the likes between the first two sightings.

    Keys seen once are left out; the category is that of the first sighting. Sightings are
    ordered by ``order`` (for instance ``readers.ARRIVAL``, the order of the lines in the
    files), or by date and then by everything else. Spark keeps two rows per key in every map
    task (window group limit) before the shuffle, so hot keys cost nothing extra.
    """
    key = ["video_id", "country"]
    by_date = [F.asc_nulls_last(BY_DATE[0]), *BY_DATE[1:]]
    in_order = Window.partitionBy(*key).orderBy(*(order or by_date))
    first_two = (
        sightings(videos, order or ())
        .withColumn("rank", F.row_number().over(in_order))
        .filter(F.col("rank") <= 2)
    )

    def at(rank: int, column: str):
        return F.max(F.when(F.col("rank") == rank, F.col(column)))

    return (
        first_two.groupBy(*key)
        .agg(
            at(1, "category").alias("category"),
            (
                (at(2, "dislikes") - at(1, "dislikes")) - (at(2, "likes") - at(1, "likes"))
            ).alias("growth"),
            F.count("*").alias("seen"),
        )
        .filter(F.col("seen") > 1)
        .select("video_id", "growth", "category", "country")
    )


def top_growth(
    videos: DataFrame, k: int = 10, order: Sequence[str] | None = None
) -> DataFrame:
    return growth(videos, order).orderBy(F.desc("growth"), "video_id", "country").limit(k)


def growth_fold() -> folding.Fold:
    """Growth between the first two of date, category, likes and dislikes, for ``fold_by_key``:
    growth, category and ``seen``, how many sightings there were, up to two."""

    def rank(row: tuple) -> list:
        # NULLs are not compared: those of the date come last, the others first
        flags = [row[0] is None, *[value is not None for value in row[1:]]]
        return [(flag, 0 if value is None else value) for flag, value in zip(flags, row, strict=True)]

    def finish(found: list[tuple]) -> tuple:
        if len(found) < 2:
            return None, found[0][1] if found else None, len(found)
        (_, category, likes, dislikes), (_, _, more_likes, more_dislikes) = found
        known = None not in (likes, dislikes, more_likes, more_dislikes)
        grown = (more_dislikes - dislikes) - (more_likes - likes) if known else None
        return grown, category, len(found)

    columns = ["{}_date date", "{}_category string", "{}_likes bigint", "{}_dislikes bigint"]
    both = [c.format(name) for name in ("first", "second") for c in columns]
    return folding.first_two(
        rank, ", ".join(["seen_so_far int", *both]), "growth bigint, category string, seen int",
        finish,
    )
