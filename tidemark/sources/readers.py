"""Readers for the file layouts the jobs start from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text
from tidemark.sources import gzip_members

# The layouts of the input files.
VIDEO_FIELDS = [
    "video_id",
    "trending_date",
    "category_id",
    "category",
    "publish_time",
    "views",
    "likes",
    "dislikes",
    "comment_count",
    "ratings_disabled",
    "video_error_or_removed",
    "country",
]
VIDEO_TYPES = {
    "category_id": "int",
    "publish_time": "timestamp",
    "views": "bigint",
    "likes": "bigint",
    "dislikes": "bigint",
    "comment_count": "bigint",
    "ratings_disabled": "boolean",
    "video_error_or_removed": "boolean",
}
REVIEW_LAYOUT = [
    "marketplace",
    "customer_id",
    "review_id",
    "product_id",
    "product_parent",
    "product_title",
    "product_category",
    "star_rating",
    "helpful_votes",
    "total_votes",
    "vine",
    "verified_purchase",
    "review_headline",
    "review_body",
    "review_date",
]
REVIEW_FIELDS = ["customer_id", "review_id", "product_id", "star_rating", "review_body"]
MOVIE_SCHEMA = "movie_id string, title string, genres string"
PHOTO_SCHEMA = (
    "photo_id string, owner string, tags string, date_taken string, "
    "place_id string, accuracy string"
)
PHOTO_TIME = "yyyy-MM-dd HH:mm:ss"
#: Where a line stands: by these columns rows are in the order in which they arrive.
ARRIVAL = ["arrival_file", "arrival_block", "arrival_place"]
FOUR_FIELDS = r"\A[^,]*+,[^,]*+,[^,]*+,[^,]*+\z"


def video_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Split lines into ``fields``; short lines and header lines go, before the split."""
    header = text.strip(F.col(line)).startswith(f"{VIDEO_FIELDS[0]},")
    whole = lines.filter(text.has_fields(F.col(line), len(VIDEO_FIELDS)) & ~header)
    return whole.withColumn("fields", text.fields(F.col(line)))


def parse_videos(
    lines: DataFrame, line: str = "value", date_format: str = dates.DAY_MONTH_YEAR,
    further: Sequence[str] = (),
) -> DataFrame:
    """Typed videos from comma-separated lines; what does not fit its type is NULL."""

    def typed(place: int, name: str):
        field = F.get("fields", F.lit(place))
        if name == "trending_date":
            return dates.parse_date(field, date_format).alias(name)
        if name in VIDEO_TYPES:
            return F.trim(field).try_cast(VIDEO_TYPES[name]).alias(name)
        return field.alias(name)

    return video_lines(lines, line).select(
        *[typed(place, name) for place, name in enumerate(VIDEO_FIELDS)], *further
    )


def read_videos(
    spark: SparkSession, path: str, date_format: str = dates.DAY_MONTH_YEAR, arrival: bool = False
) -> DataFrame:
    """Videos of a file or folder; with ``arrival``, also where each line stands, in the columns
    ``ARRIVAL``: by them rows are in the order of the files' names and of their lines."""
    lines = spark.read.text(path)
    if not arrival:
        return parse_videos(lines, "value", date_format)
    return parse_videos(with_arrival(lines), "value", date_format, ARRIVAL)


def with_arrival(lines: DataFrame) -> DataFrame:
    """Rows of a file scan with the path of their file, the block of it that a task read, and
    their place among the rows of that task, which orders those of a block."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    where = F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), place
    return lines.select(
        "*", *[column.alias(name) for name, column in zip(ARRIVAL, where, strict=True)]
    )


def read_reviews(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = REVIEW_LAYOUT,
    rebalance: bool = False,
) -> DataFrame:
    """Tab-separated reviews with a header, plain or gzipped, of which five columns are kept.

    ``columns`` are those of the files, in order. Every file's header is compared with them,
    and one that differs fails the job; read files of another layout by themselves. Nothing
    is read before the result is. A gzipped file is read by one task however large it is;
    ``rebalance`` deals its rows out by review, which pays before work on the texts and not
    before a mere count.
    """
    schema = ", ".join(f"`{name}` string" for name in columns)
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", "\t")
        .csv(path)
    )
    reviews = raw.select(*REVIEW_FIELDS).withColumn(
        "star_rating", F.col("star_rating").try_cast("int")
    )
    return reviews.hint("rebalance", "review_id") if rebalance else reviews


def read_gzip_reviews(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = REVIEW_LAYOUT,
    stretch_bytes: int = gzip_members.STRETCH_BYTES,
) -> DataFrame:
    """Reviews as ``read_reviews`` gives them, from gzip files of several members, each of
    which is read by as many tasks as its runs of members allow."""
    schema = ", ".join(f"`{name}` string" for name in columns)
    lines = gzip_members.read_lines(spark, path, "\t".join(columns), stretch_bytes)
    review = F.from_csv("value", F.lit(schema), {"sep": "\t"})
    whole = lines.filter(F.col("value").rlike(r"[^\x00-\x20]"))  # as the file reader does
    return whole.select(review.alias("r")).select(
        *[
            F.col(f"r.{name}").try_cast("int").alias(name) if name == "star_rating"
            else F.col(f"r.{name}")
            for name in REVIEW_FIELDS
        ]
    )


def read_movies(spark: SparkSession, path: str, genre_sep: str = "|") -> DataFrame:
    """Quoted CSV of id, title and genres; lines with another number of fields go."""
    raw = (
        spark.read.schema(MOVIE_SCHEMA)
        .option("mode", "DROPMALFORMED")
        .option("columnPruning", False)  # keeps the field count of a line checked
        .option("escape", '"')
        .csv(path)
    )
    genres = F.coalesce("genres", F.lit(""))  # an empty field is one genre without a name
    return raw.withColumn("genres", F.split(genres, f"\\Q{genre_sep}\\E"))


def parse_ratings(lines: DataFrame, line: str = "value") -> DataFrame:
    """Movie and rating from lines of user, movie, rating, time; bad lines go."""
    parts = F.split(F.col(line), ",")
    rating = numbers.try_double(F.get(parts, F.lit(2)))
    return (
        lines.filter(F.col(line).rlike(FOUR_FIELDS))
        .select(F.get(parts, F.lit(1)).alias("movie_id"), rating.alias("rating"))
        .filter(F.col("rating").isNotNull())
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return parse_ratings(spark.read.text(path))


def read_photos(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated photos without a header; tags are separated by spaces."""
    raw = spark.read.schema(PHOTO_SCHEMA).option("sep", "\t").option("quote", "").csv(path)
    tags = F.filter(F.split("tags", " "), lambda tag: tag != "")
    return raw.select(
        "photo_id",
        "owner",
        F.coalesce(tags, F.array().cast("array<string>")).alias("tags"),
        F.try_to_timestamp("date_taken", F.lit(PHOTO_TIME)).alias("date_taken"),
        "place_id",
        F.col("accuracy").try_cast("int").alias("accuracy"),
    )
