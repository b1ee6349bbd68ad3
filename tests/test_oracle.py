"""Every query with SQL gives the rows that DuckDB gives; every query gives rows."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tests.compare import connect, oracle_rows, spark_rows
from tidemark.plans.oracle import ORACLE as SQL
from tidemark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name not in SQL:
        assert df.limit(1).count() == 1
        return
    names, rows = spark_rows(df)
    expected_names, expected = oracle_rows(con, SQL[name])
    assert names == expected_names
    assert rows == expected


@pytest.fixture(scope="module")
def scattered(spark, sf_dir, tmp_path_factory):
    """The same tables in many files and in another order, so that scans have many tasks."""
    folder = tmp_path_factory.mktemp("scattered")
    for name in ("documents", "labels", "embeddings", "orders", "lineitem", "part", "supplier"):
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        df.repartition(13, F.xxhash64(df.columns[0], F.lit(7))).write.parquet(
            f"{folder}/{name}.parquet"
        )
    return str(folder)


@pytest.mark.parametrize("name", list(SQL))
def test_query_over_many_files(spark, con, scattered, name):
    _, rows = spark_rows(QUERIES[name](spark, scattered))
    _, expected = oracle_rows(con, SQL[name])
    assert rows == expected


def test_every_query_has_sql():
    # a fitted model's neighbours are no SQL; q24 ranks them anew instead
    assert set(QUERIES) - set(SQL) == {"q54_word2vec_neighbours"} and set(SQL) <= set(QUERIES)


def test_entry(spark, sf_dir):
    df = spark_entry.entry(spark)
    assert df.columns == [
        "sentiment", "review_id", "pos", "centre_review_id", "centre_pos", "centre_sentence",
        "distance", "rank",
    ]
    assert df.count() > 0
