"""Photo tags and who uses them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.sources import scratch


def tag_owners(photos: DataFrame) -> DataFrame:
    """How often each owner uses each ASCII tag; a missing owner is one without a name."""
    tag, owner = F.col("tag"), F.coalesce("owner", F.lit("")).alias("owner")
    return (
        photos.select(owner, F.explode_outer("tags").alias("tag"))
        .filter((tag != "") & text.is_ascii(tag))
        .groupBy("tag", "owner")
        .agg(F.count("*").alias("n"))
    )


def inverted_list(photos: DataFrame, owners_per_row: int = 10_000) -> DataFrame:
    """Tag to ``owner=count,owner=count,``, busiest owner first, then by name, in pages.

    Page i of a tag holds its owners from rank ``i * owners_per_row`` on; a tag with no more
    owners than that is page 0. Owners are sorted by range over all tags, so the owners of a
    busy tag lie in several tasks; each adds to its own places the number of the tag's owners
    in the tasks before. The sorted counts are written when this is called.
    """
    counts = tag_owners(photos).withColumn("order", -F.col("n"))
    ordered = counts.repartitionByRange("tag", "order", "owner").sortWithinPartitions(
        "tag", "order", "owner"
    )
    place = F.monotonically_increasing_id()  # the task, and the row within it
    table = scratch.written(
        ordered.withColumn("place", place).withColumn("task", F.shiftright("place", 33)),
        "owner-counts",
    )
    in_task = table.groupBy("tag", "task").agg(F.min("place").alias("first"), F.count("*").alias("m"))
    tasks_in_order = Window.partitionBy("tag").orderBy("task")
    before = in_task.select(
        "tag", "task", "first", (F.sum("m").over(tasks_in_order) - F.col("m")).alias("before")
    )
    rank = F.col("before") + F.col("place") - F.col("first")
    return (
        table.join(before, ["tag", "task"])
        .withColumn("page", F.floor(rank / owners_per_row))
        .groupBy("tag", "page")
        .agg(F.sort_array(F.collect_list(F.struct("order", "owner", "n"))).alias("entries"))
        .select(
            "tag",
            "page",
            F.array_join(
                F.transform(
                    "entries",
                    lambda e: F.concat(
                        e["owner"], F.lit("="), e["n"].cast("string"), F.lit(",")
                    ),
                ),
                "",
            ).alias("owners"),
        )
    )
