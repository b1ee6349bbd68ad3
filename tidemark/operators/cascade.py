"""Keep the reviews of active customers on active products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.sources import scratch


def with_sentences(reviews: DataFrame, body: str = "review_body") -> DataFrame:
    """Replace the body with its list of sentences and count them."""
    return reviews.withColumn(body, text.sentences(F.col(body))).withColumn(
        "num_sentences", F.size(body)
    )


def at_least_sentences(reviews: DataFrame, least: int, body: str = "review_body") -> DataFrame:
    """Reviews of at least so many sentences, which are split only in those that stay."""
    return with_sentences(reviews.filter(text.has_sentences(F.col(body), least)), body)


def _limit(threshold: float | DataFrame) -> Column:
    """A threshold is a number, or a one-row frame that is read as a scalar subquery."""
    return threshold.scalar() if isinstance(threshold, DataFrame) else F.lit(threshold)


def active_reviews(
    reviews: DataFrame,
    least_sentences: int,
    customer_above: float | DataFrame,
    product_above: float | DataFrame,
    customer: str = "customer_id",
    product: str = "product_id",
    body: str = "review_body",
) -> DataFrame:
    """Reviews with enough sentences, by customers with more than ``customer_above`` such
    reviews, on products with more than ``product_above`` of what is then left.

    Both cuts depend only on how many reviews each (customer, product) pair has. Those
    counts are written once as a narrow table, in which a busy customer or product has
    already shrunk; without it Catalyst would move the first semi-join below the count and
    read all texts again for each cut. The kept keys are written too, so that Spark knows
    their size: it broadcasts small ones, and otherwise shuffles both sides, which is what
    the adaptive skew join needs to split a hot key. Texts meet the outcome in one
    semi-join on the pair.
    """
    long_enough = reviews.filter(text.has_sentences(F.col(body), least_sentences))
    pairs = (
        long_enough.filter(F.col(customer).isNotNull())
        .groupBy(customer, product)
        .agg(F.count("*").alias("n"))
    )
    pairs = scratch.written(pairs, "pair-counts")

    def above(df: DataFrame, key: str, threshold: float | DataFrame) -> DataFrame:
        sizes = df.groupBy(key).agg(F.sum("n").alias("total"))
        kept = sizes.filter(F.col("total") > _limit(threshold)).select(key)
        return scratch.written(kept, f"kept-{key}")

    pairs = pairs.join(above(pairs, customer, customer_above), customer, "left_semi")
    pairs = pairs.join(above(pairs, product, product_above), product, "left_semi")
    kept = long_enough.join(pairs, [customer, product], "left_semi")
    return with_sentences(kept, body)
