import datetime
from collections import defaultdict

import numpy as np
import pytest

from tidemark.operators import trending

VIDEO = (
    "video_id string, country string, trending_date date, category string, "
    "likes bigint, dislikes bigint"
)


def day(n):
    return datetime.date(2018, 1, 1) + datetime.timedelta(days=n)


def test_mean_countries_per_video(spark):
    rows = [
        ("a_1", "US", "Music"), ("a_1", "US", "Music"), ("a_1", "GB", "Music"),
        ("a", "US", "Music"), ("x,y", "DE", "News"), ("x,y", "FR", "News"),
        ("", "US", "News"), ("b", "US", "Film"),
    ]
    df = spark.createDataFrame(rows, "video_id string, country string, category string")
    found = {r.category: r.countries_per_video for r in trending.countries_per_video(df).collect()}
    assert found == {"Music": 3 / 2, "News": 3 / 2, "Film": 1.0}
    found = {r.category: r.countries_per_video
             for r in trending.countries_per_video_text(df).collect()}
    assert found == {"Music": "1.50", "News": "1.50", "Film": "1.00"}


def test_growth_takes_the_first_two_dates(spark):
    rows = [
        ("v", "US", day(5), "Late", 100, 100),
        ("v", "US", day(1), "First", 10, 1),
        ("v", "US", day(3), "Second", 15, 9),
        ("once", "US", day(1), "X", 1, 1),
        ("v", "GB", day(1), "X", 1, 1),
        ("tie", "US", day(1), "B", 5, 5),
        ("tie", "US", day(1), "A", 7, 6),
        ("same", "US", day(1), "A", 7, 6),
        ("same", "US", day(1), "A", 7, 6),
        ("late", "US", None, "A", 0, 0),
        ("late", "US", day(1), "B", 2, 3),
    ]
    df = spark.createDataFrame(rows, VIDEO).repartition(5)
    found = {(r.video_id, r.country): (r.growth, r.category)
             for r in trending.growth(df).collect()}
    assert found == {
        ("v", "US"): ((9 - 1) - (15 - 10), "First"),
        ("tie", "US"): ((5 - 6) - (5 - 7), "A"),
        ("same", "US"): (0, "A"),
        ("late", "US"): ((0 - 3) - (0 - 2), "B"),
    }


@pytest.fixture(scope="module")
def hot_rows():
    rng = np.random.default_rng(5)
    return [
        (
            "hot" if rng.random() < 0.4 else f"v{rng.integers(0, 80)}",
            "US" if rng.random() < 0.7 else "GB",
            day(int(rng.integers(0, 400))),
            f"c{rng.integers(0, 4)}",
            int(rng.integers(0, 1000)),
            int(rng.integers(0, 1000)),
        )
        for _ in range(2000)
    ]


def test_growth_against_brute_force_with_a_hot_key(spark, hot_rows, executed):
    groups = defaultdict(list)
    for row in hot_rows:
        groups[row[:2]].append(row[2:])
    expected = set()
    for (video, country), seen in groups.items():
        if len(seen) > 1:
            (_, category, likes, dislikes), (_, _, likes2, dislikes2) = sorted(seen)[:2]
            expected.add((video, (dislikes2 - dislikes) - (likes2 - likes), category, country))
    for parts in (1, 13):
        growth = trending.growth(spark.createDataFrame(hot_rows, VIDEO).repartition(parts))
        assert {tuple(r) for r in growth.collect()} == expected
    plan = executed(growth)
    # two rows per key leave a map task, and nothing is shuffled again after that
    assert plan.index("row_number(), 2, Final") < plan.index("row_number(), 2, Partial")
    assert plan.count("Exchange hashpartitioning") == 1
    top = [tuple(r) for r in trending.top_growth(
        spark.createDataFrame(hot_rows, VIDEO), 10).collect()]
    assert top == sorted(expected, key=lambda r: (-r[1], r[0], r[3]))[:10]


def test_growth_in_the_order_of_the_lines(spark, tmp_path):
    """Dates say otherwise; lines are compared as they stand, over files and blocks."""
    from tidemark.sources import readers

    def line(video, date, likes, dislikes):
        fields = dict.fromkeys(readers.VIDEO_FIELDS, "x") | {
            "video_id": video, "trending_date": date, "category": date, "likes": str(likes),
            "dislikes": str(dislikes), "country": "US",
        }
        return ",".join(fields.values())

    filler = [line(f"f{i}", "01.01.18", 0, 0) for i in range(400)]
    (tmp_path / "a.csv").write_text("\n".join([line("v", "03.01.18", 10, 1), *filler]) + "\n")
    (tmp_path / "b.csv").write_text(
        "\n".join([*filler[:200], line("v", "02.01.18", 12, 9), line("v", "01.01.18", 0, 0)]) + "\n"
    )
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        videos = readers.read_videos(spark, str(tmp_path), arrival=True)
        assert videos.rdd.getNumPartitions() > 4
        found = {r.video_id: r for r in trending.growth(videos, readers.ARRIVAL).collect()}
        by_date = {r.video_id: r for r in trending.growth(videos).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (found["v"].growth, found["v"].category) == (8 - 2, "03.01.18")
    assert (by_date["v"].growth, by_date["v"].category) == (9 - 12, "01.01.18")
    assert videos.columns == [*readers.VIDEO_FIELDS, *readers.ARRIVAL]
