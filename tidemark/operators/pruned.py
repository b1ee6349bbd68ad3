"""The vectors nearest to the centres of their classes, without reading all of them.

Unit vectors a distance apart (``sqrt(2 - 2 cos)``, a metric) lie at distances from a pivot
that differ by no more than that. A layout stores each vector with its nearest pivot of the
class and the distance to it, sorted by both, in small row groups. A search first looks at the
vectors of the pivot nearest to the centre; the k-th best of them bounds how far the others'
distances may be from the centre's, and the scan skips row groups outside these bounds. What
is left is ranked by exact products, so the result is that of ``centres.nearest_to_centres``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import vectors as v
from tidemark.operators import centres
from tidemark.operators.centres import DIGITS, ID, SCALE
from tidemark.sources import scratch

PIVOTS = 16
#: Bytes of a row group, the least that a scan skips.
ROW_GROUP = 1 << 18
#: Bounds (a class and a pivot each) that become conditions of the scan; more are joined.
CONDITIONS = 1_000
#: What rounding of unit vectors and square roots may add to a distance.
SLACK = 1e-6


@dataclass(frozen=True)
class Layout:
    """``rows``: class, id, ``unit``, ``pivot`` and ``pivot_distance``; ``pivots``: class, ``pivot``
    and its unit vector ``at``; ``total``: how many rows there are."""

    rows: DataFrame
    pivots: DataFrame
    group: str
    total: int


def _distance(product: Column) -> Column:
    cosine = product / float(SCALE * SCALE)
    return F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * cosine))


def laid_out(
    units: DataFrame, group: str = "sentiment", pivots: int = PIVOTS, row_group: int = ROW_GROUP
) -> Layout:
    """A layout of the unit vectors that have a direction. Pivots are rows of the class, chosen
    by a hash of their ids."""
    directed = units.filter(F.col("unit").isNotNull()).select(group, *ID, "unit")
    by_hash = Window.partitionBy(group).orderBy(F.xxhash64(*ID), *ID)
    chosen = scratch.written(
        directed.withColumn("pivot", F.row_number().over(by_hash))
        .filter(F.col("pivot") <= pivots)
        .select(group, "pivot", F.col("unit").alias("at")),
        "pivots",
    )
    of_class = chosen.groupBy(F.col(group).alias("_class")).agg(
        F.collect_list(F.struct("pivot", "at")).alias("_pivots")
    )

    def to_pivot(p: Column) -> Column:
        products = F.zip_with("unit", p["at"], lambda a, b: a * b)
        product = F.aggregate(products, F.lit(0).cast("bigint"), lambda total, x: total + x)
        return F.struct(_distance(product).alias("distance"), p["pivot"].alias("pivot"))

    nearest = F.array_min(F.transform("_pivots", to_pivot))
    measured = directed.join(of_class, directed[group].eqNullSafe(of_class["_class"])).select(
        group, *ID, "unit", nearest.alias("_nearest")
    )
    placed = measured.select(
        group, *ID, "unit", F.col("_nearest.pivot").alias("pivot"),
        F.col("_nearest.distance").alias("pivot_distance"),
    )
    order = [group, "pivot", "pivot_distance"]
    path = scratch.scratch_path(units.sparkSession, "pruned-layout")
    sorted_rows = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows.write.option("parquet.block.size", row_group).parquet(path)
    rows = units.sparkSession.read.schema(placed.schema).parquet(path)
    return Layout(rows, chosen, group, rows.count())


def _within(layout: Layout, bounds: DataFrame) -> DataFrame:
    """The rows whose pivot distance lies between ``low`` and ``high`` of their class and
    pivot: a row of bounds each."""
    group = layout.group
    few = bounds.limit(CONDITIONS + 1).collect()
    if len(few) > CONDITIONS:
        own = bounds.toDF("_class", "_pivot", "low", "high")
        return layout.rows.join(
            own,
            F.col(group).eqNullSafe(F.col("_class"))
            & (F.col("pivot") == F.col("_pivot"))
            & F.col("pivot_distance").between(F.col("low"), F.col("high")),
            "left_semi",
        )
    conditions = [
        (F.col(group).isNull() if row[0] is None else F.col(group) == F.lit(row[0]))
        & (F.col("pivot") == row[1])
        & F.col("pivot_distance").between(row[2], row[3])
        for row in few
    ]
    return layout.rows.filter(reduce(or_, conditions, F.lit(False)))


def candidates(layout: Layout, centre: DataFrame, k: int) -> DataFrame:
    """The rows that may be among the k nearest to the centre of their class. ``centre`` has
    the class, the ids and the unit vector of one row per class."""
    group = layout.group
    own = centre.select(
        F.col(group).alias("_class"), F.col("unit").alias("centre"),
        F.col("review_id").alias("_id"), F.col("pos").alias("_pos"),
    )
    apart = scratch.written(
        layout.pivots.join(own, layout.pivots[group].eqNullSafe(own["_class"])).select(
            group, "pivot", _distance(v.exact_dot("at", "centre")).alias("apart")
        ),
        "pivot-distances",
    )
    home = apart.groupBy(group).agg(F.min(F.struct("apart", "pivot"))["pivot"].alias("pivot"))
    whole = (F.lit(0.0).alias("low"), F.lit(2.0 + SLACK).alias("high"))
    first = _within(layout, home.select(group, "pivot", *whole))
    near = Window.partitionBy(group).orderBy("distance")
    reached = (
        first.join(own, first[group].eqNullSafe(own["_class"]))
        .filter((F.col("review_id") != F.col("_id")) | (F.col("pos") != F.col("_pos")))
        .select(group, _distance(v.exact_dot("unit", "centre")).alias("distance"))
        .withColumn("rank", F.row_number().over(near))
        .filter(F.col("rank") == k)
        .select(F.col(group).alias("_class"), F.col("distance").alias("radius"))
    )
    bounds = apart.join(reached, apart[group].eqNullSafe(reached["_class"]), "left").withColumn(
        "radius", F.coalesce("radius", F.lit(2.0)) + SLACK  # too few rows there: all may be near
    )
    low, high = F.col("apart") - F.col("radius"), F.col("apart") + F.col("radius")
    return _within(layout, bounds.select(group, "pivot", low.alias("low"), high.alias("high")))


def nearest_to_centres(
    layout: Layout, centre: DataFrame, k: int = 10, digits: int = DIGITS
) -> DataFrame:
    """The k vectors nearest to the centre of their class, the centre itself excluded: class,
    ids, the centre's ids, distance and rank, as the search over all vectors gives them."""
    group = layout.group
    own = centre.select(
        F.col(group).alias("_class"),
        F.col("review_id").alias("centre_review_id"),
        F.col("pos").alias("centre_pos"),
        F.col("unit").alias("centre"),
    )
    found = candidates(layout, centre, k)
    others = (
        found.join(own, found[group].eqNullSafe(own["_class"]))
        .filter(
            (F.col("review_id") != F.col("centre_review_id"))
            | (F.col("pos") != F.col("centre_pos"))
        )
        .withColumn("product", v.exact_dot("unit", "centre"))
        .select(group, *ID, "centre_review_id", "centre_pos", "product")
    )
    ranked = centres.nearest(others, group, k)
    return ranked.select(
        group, *ID, "centre_review_id", "centre_pos",
        centres.distance(F.col("product"), digits).alias("distance"), "rank",
    )
