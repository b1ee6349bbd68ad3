from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ratings, tags


def test_average_rating_per_genre(spark, executed):
    movies = spark.createDataFrame(
        [("1", ["A", "B"]), ("2", ["B"]), ("3", ["C"]), ("4", ["A", "A"])],
        "movie_id string, genres array<string>",
    )
    scores = [("1", 4.0)] * 50 + [("2", 1.0), ("2", 2.0), ("9", 5.0), ("4", 1.0)]
    rated = spark.createDataFrame(scores, "movie_id string, rating double").repartition(4)
    found = {r.genre: r.average_rating
             for r in ratings.average_rating_per_genre(movies, rated).collect()}
    assert found == {"A": pytest.approx(202 / 52), "B": pytest.approx(203 / 52)}
    assert {tuple(r) for r in ratings.movie_genres(movies).collect()} == {
        ("1", "A"), ("1", "B"), ("2", "B"), ("3", "C"), ("4", "A"),
    }


@pytest.fixture(scope="module")
def photos(spark):
    rows = [(f"o{i % 97}", ["dog"] + (["dog", "cat"] if i % 5 == 0 else []) + ["", "café"])
            for i in range(500)]
    rows += [("solo", ["cat"]), ("none", []), (None, ["cat"]), ("", ["cat"])]
    return spark.createDataFrame(rows, "owner string, tags array<string>").repartition(5)


def expected(photos):
    counts = Counter()
    for row in photos.collect():
        for tag in row.tags:
            if tag and tag.isascii():
                counts[tag, row.owner or ""] += 1
    return counts


def test_tag_owners(photos):
    counts = expected(photos)
    found = {(r.tag, r.owner): r.n for r in tags.tag_owners(photos).collect()}
    assert found == counts
    assert sum(found.values()) == 500 + 2 * 100 + 3


def test_inverted_list_is_one_line_per_tag(photos):
    counts = expected(photos)
    found = {r.tag: (r.page, r.owners) for r in tags.inverted_list(photos).collect()}
    for tag in ("dog", "cat"):
        own = sorted((-n, owner) for (t, owner), n in counts.items() if t == tag)
        assert found[tag] == (0, "".join(f"{owner}={-n}," for n, owner in own))


@pytest.mark.parametrize("owners_per_row", [1, 30, 97])
def test_long_lists_are_cut_into_pages_in_order(photos, owners_per_row):
    counts = expected(photos)
    rows = tags.inverted_list(photos, owners_per_row).collect()
    pages = {(r.tag, r.page): r.owners for r in rows}
    assert len(pages) == len(rows)
    for tag in ("dog", "cat"):
        own = [f"{o}={-n}," for n, o in sorted((-n, o) for (t, o), n in counts.items() if t == tag)]
        for page in range(-(-len(own) // owners_per_row)):
            part = own[page * owners_per_row : (page + 1) * owners_per_row]
            assert pages.pop((tag, page)) == "".join(part)
    assert not pages


def test_hot_tag_lies_in_several_tasks(spark, conf):
    """One tag holds most of the owners; its order holds across tasks and nothing is lost."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    hot = spark.range(30_000, numPartitions=8).select(
        F.concat(F.lit("o"), "id").alias("owner"),
        F.array(F.lit("hot"), F.concat(F.lit("t"), F.col("id") % 900)).alias("tags"),
    )
    rows = tags.inverted_list(hot, owners_per_row=500).filter("tag = 'hot'").collect()
    assert len(rows) == 60
    owners = [e for r in sorted(rows, key=lambda r: r.page) for e in r.owners.split(",") if e]
    assert owners == [f"{owner}=1" for owner in sorted(f"o{i}" for i in range(30_000))]
    assert all(r.owners.count(",") == 500 for r in rows)
