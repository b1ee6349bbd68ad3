import datetime
import gzip

import pytest

from tidemark.operators import cascade, ratings, sentences, tags, trending
from tidemark.sources import readers, scratch, sinks

HEADER = ",".join(readers.VIDEO_FIELDS)


def video_line(video="v_1", date="14.11.17", likes="5", country="US", category="Music"):
    return (
        f"{video},{date},10,{category},2017-11-13 17:00:01,100,{likes},2,3,False,False,{country}"
    )


def test_videos(spark, tmp_path):
    lines = [
        HEADER,
        video_line(),
        video_line(date="15.11.17", likes="9") + "\r",
        video_line(video="short").rsplit(",", 1)[0],
        video_line(video="empty", country=""),
        video_line(video="extra") + ",more",
        video_line(video="junk", likes="many", date="?"),
        "",
        HEADER,
    ]
    path = tmp_path / "videos.csv"
    path.write_text("\n".join(lines))
    videos = readers.read_videos(spark, str(path))
    assert videos.columns == readers.VIDEO_FIELDS
    rows = {(r.video_id, r.likes): r for r in videos.collect()}
    assert set(rows) == {("v_1", 5), ("v_1", 9), ("extra", 5), ("junk", None)}
    first = rows["v_1", 5]
    assert first.trending_date == datetime.date(2017, 11, 14)
    assert (first.category_id, first.views, first.country) == (10, 100, "US")
    assert first.ratings_disabled is False and first.publish_time.year == 2017
    assert rows["junk", None].trending_date is None
    growth = [tuple(r) for r in trending.growth(videos).collect()]
    assert growth == [("v_1", -4, "Music", "US")]


def test_reviews_from_gzip(spark, tmp_path):
    names = (
        "marketplace customer_id review_id product_id product_parent star_rating "
        "review_headline review_body review_date"
    ).split()
    lines = [
        "US\tc1\tr1\tp1\t0\t5\thead\tGood. Very good!\t2015-01-01",
        "US\tc2\tr2\tp1\t0\tjunk\thead\t\t2015-01-01",
    ]
    path = tmp_path / "reviews.tsv.gz"
    with gzip.open(path, "wt") as file:
        file.write("\n".join(["\t".join(names), *lines]))
    for rebalance in (True, False):
        reviews = readers.read_reviews(spark, str(path), names, rebalance)
        assert sorted(tuple(r) for r in reviews.collect()) == [
            ("c1", "r1", "p1", 5, "Good. Very good!"),
            ("c2", "r2", "p1", None, None),
        ]
    spread = readers.read_reviews(spark, str(path), names, rebalance=True)
    plan = spread.select("review_id")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in plan and "review_body" not in plan
    counted = cascade.with_sentences(reviews).collect()
    assert {r.review_id: r.num_sentences for r in counted} == {"r1": 2, "r2": 0}
    assert [r.sentiment for r in sentences.with_sentiment(reviews).collect()] == ["positive"]


def test_movies_and_ratings(spark, tmp_path):
    movies = tmp_path / "movies.csv"
    movies.write_text(
        '1,"American President, The (1995)",Comedy|Drama\n'
        "2,Heat,Action,extra\n"
        "3,Short\n"
        '4,"Say ""hi"", now",Drama\n'
        "5,No genre,\n"
    )
    scores = tmp_path / "ratings.csv"
    scores.write_text(
        "userId,movieId,rating,timestamp\nu,1,4.0,9\nu,4,x,9\nu,4,2,9\nu,1\nu,9,5,9\nu,1,3,9,9\n"
    )
    read = readers.read_movies(spark, str(movies))
    assert {r.movie_id: (r.title, r.genres) for r in read.collect()} == {
        "1": ("American President, The (1995)", ["Comedy", "Drama"]),
        "4": ('Say "hi", now', ["Drama"]),
        "5": ("No genre", [""]),
    }
    # the field count is checked even when one column is read
    assert sorted(r[0] for r in read.select("movie_id").collect()) == ["1", "4", "5"]
    assert read.count() == 3
    rated = readers.read_ratings(spark, str(scores))
    assert sorted(tuple(r) for r in rated.collect()) == [("1", 4.0), ("4", 2.0), ("9", 5.0)]
    found = {r.genre: r.average_rating
             for r in ratings.average_rating_per_genre(read, rated).collect()}
    assert found == {"Comedy": 4.0, "Drama": 3.0}


def test_photos(spark, tmp_path):
    path = tmp_path / "photos.txt"
    path.write_text(
        '1\tann\tsea boat "sun\t2011-03-04 05:06:07\tP1\t16\n'
        "2\tann\tsea  sea\tnever\tP2\tx\n"
        "3\tbob\t\t2011-03-04 05:06:07\tP1\t1\n"
    )
    photos = readers.read_photos(spark, str(path))
    rows = {r.photo_id: r for r in photos.collect()}
    assert rows["1"].tags == ["sea", "boat", '"sun'] and rows["1"].accuracy == 16
    assert rows["1"].date_taken == datetime.datetime(2011, 3, 4, 5, 6, 7)
    assert rows["2"].date_taken is None and rows["2"].accuracy is None
    assert rows["3"].tags == []
    found = {r.tag: r.owners for r in tags.inverted_list(photos).collect()}
    assert found == {"sea": "ann=3,", "boat": "ann=1,", '"sun': "ann=1,"}


def test_text_sink_fixes_the_number_of_parts(spark, tmp_path):
    df = spark.range(100).selectExpr("concat('k', id) AS key", "id AS n")
    path = tmp_path / "out"
    sinks.write_text(df, str(path), parts=3, key="key")
    assert len(list(path.glob("part-*"))) == 3
    back = spark.read.schema("key string, n bigint").option("sep", "\t").csv(str(path))
    assert sorted(back.collect()) == sorted(df.collect())
    with pytest.raises(Exception, match="exists"):
        sinks.write_text(df, str(path))


def test_table_sink(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS part")
    sinks.write_table(df, str(tmp_path / "t"), ["part"])
    assert sorted(p.name for p in (tmp_path / "t").glob("part=*")) == ["part=0", "part=1"]
    assert spark.read.parquet(str(tmp_path / "t")).filter("part = 1").count() == 5


class Session:
    """Just what the choice of the folder looks at."""

    def __init__(self, named=None, given=None, master="local[8]"):
        self.sparkContext = self
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.folder, self.master = given, master

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_is_the_folder_the_session_names():
    assert scratch.shared_folder(Session("/shared/x/", "/y", "yarn")) == "/shared/x"
    assert scratch.shared_folder(Session(None, "/given", "yarn")) == "/given"
    local = Session()
    assert scratch.shared_folder(local) == scratch.shared_folder(local) == local.folder
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session(master="spark://host:7077"))


def test_written_tables_have_a_folder_of_their_own(spark):
    first, second = (scratch.written(spark.range(3), "ids") for _ in range(2))
    folder = scratch.shared_folder(spark)
    assert all(folder in path for path in first.inputFiles() + second.inputFiles())
    assert not set(first.inputFiles()) & set(second.inputFiles())
    assert first.count() == second.count() == 3


def test_clear_removes_what_was_written(spark):
    path = scratch.scratch_path(spark, "x").rsplit("/", 1)[0]
    df = scratch.written(spark.range(5), "some")
    assert df.count() == 5
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.exists(folder)
    scratch.clear(spark)
    assert not files.exists(folder)


def test_written_by_folder(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, kind string")
    again = scratch.written(df, "kinds", partition_by=["kind"])
    assert again.columns == ["n", "kind"] and sorted(again.collect()) == sorted(df.collect())


def test_review_files_with_another_header_are_refused(spark, tmp_path):
    columns = ["customer_id", "review_id", "product_id", "star_rating", "review_body"]
    row = dict(zip(columns, ["c1", "r1", "p1", "5", "Good."], strict=True))
    swapped = [columns[1], columns[0], *columns[2:]]
    for name, order in (("a.tsv", columns), ("b.tsv", swapped)):
        lines = ["\t".join(order), "\t".join(row[c] for c in order)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        readers.read_reviews(spark, str(tmp_path), columns).collect()
    for name, order in (("a.tsv", columns), ("b.tsv", swapped)):
        found = readers.read_reviews(spark, str(tmp_path / name), order).first()
        assert (found.customer_id, found.review_id, found.star_rating) == ("c1", "r1", 5)


def test_reading_reviews_starts_no_job(spark, tmp_path):
    spark.sparkContext.setJobGroup("plan-only", "")
    (tmp_path / "a.tsv").write_text("x\n")
    readers.read_reviews(spark, str(tmp_path))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
