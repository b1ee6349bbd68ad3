"""Exact quantiles and ranks per key, whatever the number of different values.

Equal values are merged and counted, then dealt out by ranges of (key, value), so parts are
of a size even if one key has most of the values. How many rows of a key each part has tells
in which part a rank lies; only there values are summed up until the rank is reached.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources import scratch


def _parted(df: DataFrame, key: str, value: str, parts: int | None) -> DataFrame:
    """Different values of a key with their counts and the range they lie in, as a table."""
    merged = (
        df.select(F.col(key).alias("key"), F.col(value).alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy("key", "value")
        .agg(F.count("*").alias("n"))
    )
    ranges = (parts, "key", "value") if parts else ("key", "value")
    return scratch.written(
        merged.repartitionByRange(*ranges).withColumn("part", F.spark_partition_id()), "values"
    )


def _at_ranks(parted: DataFrame, wanted: DataFrame) -> DataFrame:
    """The value at each wanted rank (from 0 on) of a key: key, rank, value."""
    # NULL is a key like others; a flag and a filled key would need a value of its type
    sizes = parted.groupBy("key", "part").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("key").orderBy("part")  # a row per part that the key lies in
    begins = sizes.withColumn("before", F.sum("n").over(before) - F.col("n"))
    ranks = wanted.select(F.col("key").alias("w_key"), "rank")
    target = begins.join(
        ranks,
        F.col("key").eqNullSafe(F.col("w_key"))
        & (F.col("rank") >= F.col("before"))
        & (F.col("rank") < F.col("before") + F.col("n")),
    ).select("w_key", F.col("part").alias("w_part"), "rank", (F.col("rank") - F.col("before")).alias("own"))
    target = scratch.written(target, "ranks")
    holding = target.select(F.col("w_key").alias("h_key"), F.col("w_part").alias("h_part")).distinct()
    within = Window.partitionBy("key", "part").orderBy("value")
    ends = (
        parted.join(
            holding,
            F.col("key").eqNullSafe(F.col("h_key")) & (F.col("part") == F.col("h_part")),
            "left_semi",
        )
        .withColumn("end", F.sum("n").over(within))
    )
    return ends.join(
        target,
        F.col("key").eqNullSafe(F.col("w_key"))
        & (F.col("part") == F.col("w_part"))
        & (F.col("own") >= F.col("end") - F.col("n"))
        & (F.col("own") < F.col("end")),
    ).select("key", "rank", "value")


def quantiles(
    df: DataFrame, key: str, value: str, fractions: Sequence[float] = (0.5,),
    parts: int | None = None,
) -> DataFrame:
    """Per key and fraction: the key, ``fraction``, ``n`` (values that are not NULL), the two
    values between which the quantile lies (``lower``, ``upper``), and ``quantile`` between
    them in proportion, a double.

    Of n values in ascending order from place 0, the quantile of a fraction f lies at place
    (n - 1) * f. A NULL key is a key; keys without a value are left out. NaN is the largest
    value. ``parts`` is the number of ranges, that of shuffles otherwise.
    """
    if not fractions or not all(0 <= f <= 1 for f in fractions):
        raise ValueError("fractions lie between 0 and 1")
    parted = _parted(df, key, value, parts)
    listed = F.explode(F.array(*[F.lit(float(f)) for f in sorted(set(fractions))]))
    places = (
        parted.groupBy("key").agg(F.sum("n").alias("n")).withColumn("fraction", listed)
        .withColumn("place", (F.col("n") - 1) * F.col("fraction"))
        .withColumn("low", F.floor("place"))
        .withColumn("high", F.ceil("place"))
    )
    places = scratch.written(places, "places")
    wanted = places.select("key", F.explode(F.array("low", "high")).alias("rank")).distinct()
    found = scratch.written(_at_ranks(parted, wanted), "at-ranks")

    def side(rank: str, name: str) -> DataFrame:
        return found.select(
            F.col("key").alias(f"{name}_key"), F.col("rank").alias(rank), F.col("value").alias(name)
        )

    joined = places
    for rank, name in (("low", "lower"), ("high", "upper")):
        other = side(rank, name)
        joined = joined.join(
            other, joined["key"].eqNullSafe(other[f"{name}_key"]) & (joined[rank] == other[rank])
        ).drop(other[rank], other[f"{name}_key"])
    lower, upper = F.col("lower").cast("double"), F.col("upper").cast("double")
    return joined.select(
        F.col("key").alias(key), "fraction", "n", "lower", "upper",
        F.when(lower == upper, lower)
        .otherwise(lower + (upper - lower) * (F.col("place") - F.col("low")))
        .alias("quantile"),
    )


def medians(df: DataFrame, key: str, value: str, parts: int | None = None) -> DataFrame:
    """Exact median per key, cut to a whole number, as ``profile.median_per_key`` gives it."""
    found = quantiles(df, key, value, (0.5,), parts)
    return found.select(key, F.col("quantile").cast("int").alias("median"))
