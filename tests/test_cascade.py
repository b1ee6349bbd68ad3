import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cascade, profile

SCHEMA = "review_id int, customer_id string, product_id string, review_body string"


def brute_force(rows, least, customer_above, product_above):
    kept = [r for r in rows if len([p for p in re.split("[.?!]", r[3] or "") if p]) >= least]
    customers = Counter(r[1] for r in kept)
    kept = [r for r in kept if r[1] is not None and customers[r[1]] > customer_above]
    products = Counter(r[2] for r in kept)
    kept = [r for r in kept if r[2] is not None and products[r[2]] > product_above]
    return sorted(r[0] for r in kept)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(900):
        customer = "hot" if rng.random() < 0.35 else f"c{rng.integers(0, 200)}"
        product = "best" if rng.random() < 0.35 else f"p{rng.integers(0, 60)}"
        body = ["a.", "a. b", "a. b. c!", "?!.", None, "a. . b?"][rng.integers(0, 6)]
        if i % 50 == 0:
            customer = None
        if i % 70 == 0:
            product = None
        rows.append((i, customer, product, body))
    return rows


@pytest.fixture(scope="module")
def reviews(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def ids(df):
    return sorted(r.review_id for r in df.collect())


def test_fixed_thresholds(reviews, rows):
    assert ids(cascade.active_reviews(reviews, 3, 1, 2)) == brute_force(rows, 3, 1, 2)


def test_median_thresholds_come_from_all_reviews(reviews, rows):
    found = cascade.active_reviews(
        reviews,
        2,
        profile.median_group_size(reviews, "customer_id"),
        profile.median_group_size(reviews, "product_id"),
    )
    customer = np.median(list(Counter(r[1] for r in rows).values()))
    product = np.median(list(Counter(r[2] for r in rows).values()))
    expected = brute_force(rows, 2, customer, product)
    assert ids(found) == expected and expected


def test_products_are_counted_after_customers(spark):
    # p has three reviews, but only two are left once the customer with one review is gone
    rows = [(1, "a", "p", "x. y"), (2, "a", "p", "x. y"), (3, "b", "p", "x. y")]
    reviews = spark.createDataFrame(rows, SCHEMA)
    assert ids(cascade.active_reviews(reviews, 2, 1, 2)) == []
    assert ids(cascade.active_reviews(reviews, 2, 1, 1)) == [1, 2]


def test_stricter_keeps_less(reviews):
    loose = set(ids(cascade.active_reviews(reviews, 2, 1, 2)))
    strict = set(ids(cascade.active_reviews(reviews, 3, 4, 8)))
    assert strict < loose


def test_sentences_and_their_number(spark):
    bodies = [(1, None), (2, "?!."), (3, "A. . B"), (4, "a.b"), (5, "a.b.c")]
    df = spark.createDataFrame(bodies, "review_id int, review_body string")
    counts = {r.review_id: r.num_sentences for r in cascade.with_sentences(df).collect()}
    assert counts == {1: 0, 2: 0, 3: 3, 4: 2, 5: 3}
    assert ids(cascade.at_least_sentences(df, 2)) == [3, 4, 5]
    assert ids(cascade.at_least_sentences(df, 3)) == [3, 5]
    assert ids(cascade.at_least_sentences(df, 0)) == [1, 2, 3, 4, 5]


@pytest.fixture
def no_broadcast(conf):
    """Joins shuffle, and the skew join looks at the small partitions of a test."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "2000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1000")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.files.maxPartitionBytes", "20000")
    conf("spark.sql.files.openCostInBytes", "0")


def split_joins(plan):
    """The keys of the joins in which adaptive execution split a hot key."""
    lines = [line for line in plan.split("\n") if "SortMergeJoin(skew=true)" in line]
    return [re.findall(r"(\w+)#", line.split("[", 1)[1].split("]")[0]) for line in lines]


def many_reviews(spark, customer, product):
    return spark.range(20_000, numPartitions=8).select(
        F.col("id").cast("int").alias("review_id"),
        F.expr(customer).alias("customer_id"),
        F.expr(product).alias("product_id"),
        F.lit("one. two").alias("review_body"),
    )


def test_hot_pair_is_split(spark, no_broadcast, executed):
    """A third of all reviews by one customer on one product."""
    reviews = many_reviews(
        spark,
        "if(id % 3 = 0, 'hot', concat('c', id % 500))",
        "if(id % 3 = 0, 'best', concat('p', id % 70))",
    )
    found = cascade.active_reviews(reviews, 2, 5, 5)
    assert ["customer_id", "product_id"] in split_joins(executed(found))
    assert found.count() == 20_000


def test_hot_customer_with_many_products_is_split(spark, no_broadcast, executed):
    reviews = many_reviews(
        spark, "if(id % 3 = 0, 'hot', concat('c', id % 500))", "concat('p', id % 7000)"
    )
    found = cascade.active_reviews(reviews, 2, 5, 1)
    assert ["customer_id"] in split_joins(executed(found))
    assert found.count() == 20_000


def test_hot_product_with_many_customers_is_split(spark, no_broadcast, executed):
    reviews = many_reviews(
        spark, "concat('c', id % 7000)", "if(id % 3 = 0, 'best', concat('p', id % 500))"
    )
    found = cascade.active_reviews(reviews, 2, 1, 5)
    assert ["product_id"] in split_joins(executed(found))
    assert found.count() == 20_000


def test_shuffled_joins_give_the_same(reviews, rows, no_broadcast):
    assert ids(cascade.active_reviews(reviews, 3, 1, 2)) == brute_force(rows, 3, 1, 2)


def test_texts_are_read_twice_and_only_for_the_pairs_and_the_outcome(spark, sf_dir, executed):
    from tidemark.plans import tables

    plan = executed(tables.active_by_median(spark, sf_dir))
    scans = [line for line in plan.split("\n") if "FileScan" in line and "documents" in line]
    assert sum("text" in line.split("[", 1)[1].split("]")[0] for line in scans) == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
