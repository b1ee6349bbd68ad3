"""Counts, distinct counts, group sizes and their median."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def distinct_count(df: DataFrame, key: str) -> DataFrame:
    """Number of different values; NULL counts as one of them."""
    return df.select(key).distinct().agg(F.count("*").alias("n"))


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def largest_group(df: DataFrame, key: str) -> DataFrame:
    return group_sizes(df, key).agg(F.max("n").alias("n"))


def top_groups(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The k keys with most rows; equal counts are ordered by key."""
    return group_sizes(df, key).orderBy(F.desc("n"), key).limit(k)


def median_group_size(df: DataFrame, key: str) -> DataFrame:
    """Exact median of the group sizes.

    The sizes are counted before the median is taken, so the last task sees one row per
    different size: fewer than sqrt(2 * rows) of them, however many groups there are.
    """
    sizes = group_sizes(df, key).groupBy("n").agg(F.count("*").alias("groups"))
    return sizes.agg(F.percentile("n", F.lit(0.5), F.col("groups")).alias("median"))


def median_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Exact median of an integer column per key, cut to a whole number.

    Equal values of a key are merged first, so a key with very many rows is spread over
    tasks and its median is taken from one row per different value.
    """
    merged = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return merged.groupBy(key).agg(
        F.percentile(value, F.lit(0.5), F.col("n")).cast("int").alias("median")
    )


def top_by_median(df: DataFrame, key: str, value: str, k: int = 10) -> DataFrame:
    return median_per_key(df, key, value).orderBy(F.desc("median"), key).limit(k)
