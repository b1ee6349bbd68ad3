import pytest
from pyspark.sql import functions as F

from tidemark.sources import quarantine, readers

HEADER = ",".join(readers.VIDEO_FIELDS)


def line(i, **changed):
    fields = {
        "video_id": f"v{i}", "trending_date": "20.11.17", "category_id": "1", "category": "Music",
        "publish_time": "2017-11-17 10:00:00", "views": "10", "likes": "5", "dislikes": "1",
        "comment_count": "", "ratings_disabled": "False", "video_error_or_removed": "False",
        "country": "US",
    }
    assert list(fields) == readers.VIDEO_FIELDS
    return ",".join({**fields, **changed}.values())


def written(tmp_path, *files):
    for i, lines in enumerate(files):
        (tmp_path / f"{i}.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def test_videos(spark, tmp_path):
    day = next(
        d for d in ("17.20.11", "20.11.17")
        if spark.range(1).select(quarantine.dates.parse_date(F.lit(d)).isNotNull()).first()[0]
    )
    good = [line(i, trending_date=day) for i in range(5)]
    bad = {
        "fields": ["v9,a,b", "x"],
        "trending_date": [line(10, trending_date="yesterday", likes="many")],
        "likes": [line(11, trending_date=day, likes="many"), line(12, trending_date=day, likes="1.x")],
        "publish_time": [line(13, trending_date=day, publish_time="then")],
        "ratings_disabled": [line(14, trending_date=day, ratings_disabled="perhaps")],
    }
    every = [b for lines in bad.values() for b in lines]
    path = written(tmp_path, [HEADER, *good[:2], *every[:4], ""], [HEADER, *every[4:], *good[2:]])
    found = quarantine.videos(spark, path)
    assert sorted(r.video_id for r in found.good.collect()) == [f"v{i}" for i in range(5)]
    assert found.good.columns == readers.VIDEO_FIELDS
    by_reason = {}
    for r in found.bad.collect():
        by_reason.setdefault(r.reason, []).append(r.line)
        assert r.file.endswith(".csv") and r.block == 0
        lines = open(r.file.removeprefix("file:").replace("//", "/")).read().split("\n")
        assert r.line in lines
    assert {k: sorted(v) for k, v in by_reason.items()} == {k: sorted(v) for k, v in bad.items()}
    expected = {k: len(v) for k, v in bad.items()}
    assert found.counts == {"lines": len(good) + len(every), "good": len(good), **expected}


def test_good_videos_are_those_that_the_reader_types(spark, tmp_path):
    lines = [HEADER, *[line(i, likes=str(i) if i % 3 else "none") for i in range(30)]]
    path = written(tmp_path, lines)
    found = quarantine.videos(spark, path)
    every = readers.read_videos(spark, path)
    dated = every.filter("trending_date is not null and likes is not null")
    assert sorted(map(str, found.good.collect())) == sorted(map(str, dated.collect()))
    assert found.good.dtypes == every.dtypes


def test_places_order_the_lines_of_a_file(spark, tmp_path):
    found = quarantine.videos(spark, written(tmp_path, [f"bad {i}" for i in range(500)]))
    assert [r.line for r in found.bad.orderBy("file", "block", "place").collect()] == [
        f"bad {i}" for i in range(500)
    ]


def test_ratings(spark, tmp_path):
    lines = ["1,2,3.5,4", "1,2,good,4", "1,2,3.5", "1,2,3.5,4,5", "", "1,9,-1e2,0", "1,2,,4"]
    path = written(tmp_path, lines)
    found = quarantine.ratings(spark, path)
    expected = sorted(map(str, readers.read_ratings(spark, path).collect()))
    assert sorted(map(str, found.good.collect())) == expected and len(expected) == 2
    assert sorted((r.reason, r.line) for r in found.bad.collect()) == [
        ("fields", ""), ("fields", "1,2,3.5"), ("fields", "1,2,3.5,4,5"), ("rating", "1,2,,4"),
        ("rating", "1,2,good,4"),
    ]
    assert found.counts == {"lines": 7, "good": 2, "fields": 3, "rating": 2}


def test_movies(spark, tmp_path):
    lines = ['1,"A, the ""one""",x|y', "2,B,x,z", "3,C", '4,D,"p|q"', ",E,x", '5,"F",']
    path = written(tmp_path, lines)
    found = quarantine.movies(spark, path)
    kept = [tuple(r) for r in readers.read_movies(spark, path).filter("movie_id is not null").collect()]
    assert sorted(map(tuple, found.good.collect()), key=str) == sorted(kept, key=str)
    assert {r.line for r in found.bad.filter("reason = 'fields'").collect()} == {"2,B,x,z", "3,C"}
    assert found.counts["lines"] == 6 and found.counts["fields"] == 2 and found.counts["movie_id"] == 1


def test_no_lines(spark, tmp_path):
    found = quarantine.ratings(spark, written(tmp_path, []))
    assert found.counts["good"] == 0 and found.good.count() == 0


def test_one_pass(spark, tmp_path):
    """What is read after the split is the written table, a folder of it each."""
    found = quarantine.ratings(spark, written(tmp_path, ["1,2,3,4", "x"]))
    for frame, folder in ((found.good, "false"), (found.bad, "true")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "text" not in plan.split("Location")[0].lower()
        assert "PartitionFilters: [isnotnull(_bad" in plan or "_bad" in plan, folder


@pytest.mark.parametrize("name", ["videos", "ratings", "movies"])
def test_files_may_be_read_twice(spark, tmp_path, name):
    path = written(tmp_path, ["1,2,3,4", "x"])
    first, second = (getattr(quarantine, name)(spark, path) for _ in range(2))
    assert first.counts == second.counts


def test_lines_are_written_as_they_come(spark, tmp_path):
    """Folders for good and bad lines would make each task sort all that it reads."""
    found = quarantine.ratings(spark, written(tmp_path, ["1,2,3,4", "x"]))
    assert found.bad.inputFiles() and not any("_bad=" in name for name in found.bad.inputFiles())
