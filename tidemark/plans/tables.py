"""The test tables seen as the inputs of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import cascade, embed, profile, sentences
from tidemark.sources import readers

PRODUCT = "en"
VECTOR_SIZE = 64
#: What a task writes to a file, about: bytes of text, or rows that it has to sort.
FILE_BYTES = 64 << 20
FILE_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(total: int, each: int, least: int) -> int:
    """How many files a total needs."""
    return max(least, -(-total // each))


def text_bytes(spark: SparkSession, sf_dir: str) -> int:
    """The bytes of all texts of the documents."""
    length = F.octet_length("text").cast("bigint")
    return table(spark, sf_dir, "documents").agg(F.sum(length)).first()[0] or 0


def reviews(spark: SparkSession, sf_dir: str, customers: int, product: str) -> DataFrame:
    """Documents as reviews; the text length, folded, stands in for the customer."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("review_id"),
        (F.col("n_chars") % customers).alias("customer_id"),
        F.col(product).alias("product_id"),
        F.col("text").alias("review_body"),
    )


def lang_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews(spark, sf_dir, 50, "lang")


def active_by_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sentences; more reviews than the median customer and product of all reviews."""
    everything = lang_reviews(spark, sf_dir)
    return cascade.active_reviews(
        everything,
        2,
        profile.median_group_size(everything, "customer_id"),
        profile.median_group_size(everything, "product_id"),
    )


def active_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sentences; customers with more than one review, products with more than two."""
    return cascade.active_reviews(reviews(spark, sf_dir, 997, "source"), 3, 1, 2)


def classed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active reviews of one product with a rating made from the quality label."""
    stars = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("review_id"), (1 + 4 * F.col("quality")).alias("star_rating")
    )
    own = sentences.reviews_of(active_by_median(spark, sf_dir), PRODUCT)
    return sentences.with_sentiment(own.join(stars, "review_id"))


def classed_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt out by review, since each sentence is much more work than reading it."""
    every = sentences.explode_sentences(classed_reviews(spark, sf_dir))
    return every.hint("rebalance", "review_id")


def tokenised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.tokenised(sentences.trimmed_sentences(classed_reviews(spark, sf_dir)))


def written_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenised sentences as a table, since fitting a model reads them several times."""
    return embed.by_class(tokenised(spark, sf_dir))


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "label",
        F.col("vec_id").alias("review_id"),
        F.lit(0).alias("pos"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sightings of a part (video) at a supplier (country)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("video_id"),
        F.col("l_suppkey").alias("country"),
        F.col("l_shipdate").cast("date").alias("trending_date"),
        F.col("l_returnflag").alias("category"),
        F.col("l_quantity").cast("bigint").alias("likes"),
        F.col("l_extendedprice").cast("bigint").alias("dislikes"),
    )


def branded_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand as category, part as video, the supplier's nation as country.

    Only different (part, supplier) pairs matter here, so they are made different first.
    """
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        pairs.join(suppliers, pairs.l_suppkey == suppliers.s_suppkey)
        .join(parts, pairs.l_partkey == parts.p_partkey)
        .select(
            F.col("p_brand").alias("category"),
            F.col("l_partkey").alias("video_id"),
            F.col("s_nationkey").alias("country"),
        )
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"), F.split("p_name", " ").alias("genres")
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("movie_id"), F.col("l_quantity").alias("rating")
    )


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rating lines; open orders carry a bad rating, pending ones a fifth field."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    rating = (
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
        .when(F.col("o_orderstatus") == "P", F.concat(price, F.lit(",")))
        .otherwise(price)
    )
    return table(spark, sf_dir, "orders").select(
        F.concat_ws(
            ",",
            F.col("o_custkey").cast("string"),
            F.col("o_orderkey").cast("string"),
            rating,
            F.date_format("o_orderdate", "yyyyMMdd"),
        ).alias("value")
    )


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("owner"), F.split("p_name", " ").alias("tags")
    )


def video_table(
    spark: SparkSession, sf_dir: str, items: DataFrame | None = None
) -> DataFrame:
    """Line items in the twelve columns of a video file."""
    date = F.col("l_shipdate")
    columns = {
        "video_id": F.col("l_partkey"),
        "trending_date": dates.format_date(date),
        "category_id": F.col("l_linenumber"),
        "category": F.col("l_returnflag"),
        "publish_time": F.date_format(date, "yyyy-MM-dd HH:mm:ss"),
        "views": F.col("l_orderkey"),
        "likes": F.col("l_quantity").cast("bigint"),
        "dislikes": F.col("l_extendedprice").cast("bigint"),
        "comment_count": F.col("l_linenumber"),
        "ratings_disabled": F.lit(False),
        "video_error_or_removed": F.lit(False),
        "country": F.when(F.col("l_linestatus") != "O", F.col("l_suppkey")),
    }
    items = table(spark, sf_dir, "lineitem") if items is None else items
    return items.select(*[columns[name].alias(name) for name in readers.VIDEO_FIELDS])


def broken_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file with dates that open lines broke and likes that returned items lost."""
    videos = video_table(spark, sf_dir)
    return videos.withColumns(
        {
            "trending_date": F.when(
                F.col("category_id") == 7, F.concat(F.lit("31."), "trending_date")
            ).otherwise(F.col("trending_date")),
            "likes": F.when(F.col("category") == "R", F.lit("many")).otherwise(
                F.col("likes").cast("string")
            ),
            "country": F.coalesce(F.col("country").cast("string"), F.lit("none")),
        }
    )


def item_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as lines of user, movie, rating, time; the rating of returned ones is no
    number, and first lines have a field too many."""
    rating = F.when(F.col("l_returnflag") == "R", "good").otherwise(
        F.col("l_quantity").cast("string")
    )
    extra = F.when(F.col("l_linenumber") == 1, "again")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            ",", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), rating,
            F.date_format("l_shipdate", "yyyyMMdd"), extra,
        ).alias("value")
    )


def review_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in columns of a review file, one line each; some ratings are no number."""
    stars = F.when(F.col("source") == "src0", "none").otherwise(F.substring("source", 4, 2))
    return table(spark, sf_dir, "documents").select(
        F.lit("US").alias("marketplace"),
        (F.col("n_chars") % 50).alias("customer_id"),
        F.col("doc_id").alias("review_id"),
        F.col("lang").alias("product_id"),
        stars.alias("star_rating"),
        F.regexp_replace("text", r"\s", " ").alias("review_body"),
    )


def review_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """The same as tab-separated lines, and the names of their columns."""
    reviews = review_table(spark, sf_dir)
    line = F.to_csv(F.struct(*reviews.columns), {"sep": "\t"})
    return reviews.select(line.alias("value")), reviews.columns


def movie_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as movie lines; economy parts have a field too many, small ones one too few."""
    title = F.concat(F.lit('"'), F.col("p_name"), F.lit(', ""the"" '), "p_type", F.lit('"'))
    genres = F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))
    line = (
        F.when(F.col("p_type") == "ECONOMY", F.concat_ws(",", "p_partkey", title, genres, genres))
        .when(F.col("p_type") == "SMALL", F.concat_ws(",", "p_partkey", title))
        .otherwise(F.concat_ws(",", "p_partkey", title, genres))
    )
    return table(spark, sf_dir, "part").select(line.alias("value"))


def photo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as photo lines: id, owner, tags, date, place, accuracy."""
    return table(spark, sf_dir, "part").select(
        F.concat_ws(
            "\t",
            F.col("p_partkey").cast("string"),
            "p_brand",
            "p_name",
            F.lit("2011-03-04 05:06:07"),
            "p_type",
            F.col("p_size").cast("string"),
        ).alias("value")
    )


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every physical line of every document."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("doc_id"),
        F.posexplode_outer(F.split("text", "\n")).alias("line_no", "value"),
    )


def video_fields(lines: DataFrame) -> DataFrame:
    """The fields that the ratio job takes from a line: id, category, country."""
    picked = [
        F.get("fields", F.lit(readers.VIDEO_FIELDS.index(name))).alias(name)
        for name in ("video_id", "category", "country")
    ]
    return readers.video_lines(lines).select("doc_id", "line_no", *picked)
