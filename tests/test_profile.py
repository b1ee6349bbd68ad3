import numpy as np
import pytest

from tidemark.operators import profile


@pytest.fixture(scope="module")
def reviews(spark):
    sizes = {"a": 5, "b": 5, "c": 2, "d": 1, None: 3, "e": 40}
    rows = [(key, i) for key, size in sizes.items() for i in range(size)]
    return spark.createDataFrame(rows, "customer string, n_s int").repartition(7)


def one(df):
    return df.collect()[0][0]


def test_counts(reviews):
    assert one(profile.row_count(reviews)) == 56
    assert one(profile.distinct_count(reviews, "customer")) == 6  # NULL is one of them
    assert one(profile.largest_group(reviews, "customer")) == 40


def test_top_groups_break_ties_by_key(reviews):
    top = profile.top_groups(reviews, "customer", 4).collect()
    assert [tuple(r) for r in top] == [("e", 40), ("a", 5), ("b", 5), (None, 3)]


def test_median_of_an_even_number_of_groups(reviews):
    assert one(profile.median_group_size(reviews, "customer")) == np.median([5, 5, 2, 1, 3, 40])
    half = reviews.filter("customer in ('c', 'a', 'd', 'e')")
    assert one(profile.median_group_size(half, "customer")) == 3.5


def test_median_per_key_cuts_to_whole_numbers(reviews):
    medians = {r.customer: r["median"] for r in
               profile.median_per_key(reviews, "customer", "n_s").collect()}
    assert medians == {"a": 2, "b": 2, "c": 0, "d": 0, None: 1, "e": 19}


def test_top_by_median(reviews):
    top = profile.top_by_median(reviews, "customer", "n_s", 3).collect()
    assert [tuple(r) for r in top] == [("e", 19), ("a", 2), ("b", 2)]


def test_partitioning_does_not_matter(reviews):
    for parts in (1, 13):
        again = reviews.repartition(parts)
        assert one(profile.median_group_size(again, "customer")) == 4
