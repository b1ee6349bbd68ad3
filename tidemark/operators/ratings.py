"""Movies, their genres and their ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def movie_genres(movies: DataFrame) -> DataFrame:
    """One row per movie and genre."""
    genres = movies.select("movie_id", F.explode_outer("genres").alias("genre"))
    return genres.filter(F.col("genre").isNotNull())


def average_rating_per_genre(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Mean rating of the movies of a genre.

    Ratings are summed per movie before the join, so a movie with very many ratings enters
    it as one row; genres are unfolded after the join.
    """
    per_movie = ratings.groupBy("movie_id").agg(
        F.sum("rating").alias("total"), F.count("rating").alias("n")
    )
    rated = movies.select("movie_id", "genres").join(per_movie, "movie_id")
    return (
        rated.select(F.explode_outer("genres").alias("genre"), "total", "n")
        .filter(F.col("genre").isNotNull())
        .groupBy("genre")
        .agg((F.sum("total") / F.sum("n")).alias("average_rating"))
    )
