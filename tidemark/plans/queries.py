"""The registered queries: name to a function of session and table folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.functions.hash_encoder import load_hash_encoder
from tidemark.functions.vectors import rounded
from tidemark.operators import (
    cascade,
    centres,
    embed,
    folding,
    positions,
    profile,
    pruned,
    ratings,
    selection,
    sentences,
    tags,
    trending,
)
from tidemark.plans import tables as t
from tidemark.sources import gzip_members, quarantine, readers, scratch, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Profile


@query
def q01_row_count(spark, sf_dir):
    return profile.row_count(t.table(spark, sf_dir, "lineitem"))


@query
def q02_distinct_customers(spark, sf_dir):
    return profile.distinct_count(t.table(spark, sf_dir, "orders"), "o_custkey")


@query
def q03_distinct_products(spark, sf_dir):
    return profile.distinct_count(t.table(spark, sf_dir, "lineitem"), "l_partkey")


@query
def q04_largest_customer(spark, sf_dir):
    return profile.largest_group(t.table(spark, sf_dir, "orders"), "o_custkey")


@query
def q05_largest_product(spark, sf_dir):
    return profile.largest_group(t.table(spark, sf_dir, "lineitem"), "l_partkey")


@query
def q06_top_customers(spark, sf_dir):
    return profile.top_groups(t.table(spark, sf_dir, "orders"), "o_custkey")


@query
def q07_top_products(spark, sf_dir):
    return profile.top_groups(t.table(spark, sf_dir, "lineitem"), "l_partkey")


@query
def q08_median_customer(spark, sf_dir):
    return profile.median_group_size(t.table(spark, sf_dir, "orders"), "o_custkey")


@query
def q09_median_product(spark, sf_dir):
    return profile.median_group_size(t.table(spark, sf_dir, "lineitem"), "l_partkey")


# Sentence counts and the cascade of active customers and products


def _shown(reviews: DataFrame) -> DataFrame:
    return reviews.select("review_id", "customer_id", "product_id", "num_sentences")


@query
def q10_sentences(spark, sf_dir):
    reviews = cascade.with_sentences(t.lang_reviews(spark, sf_dir))
    return reviews.select(
        "review_id", "num_sentences", F.array_join("review_body", "|").alias("sentences")
    )


@query
def q11_min_sentences(spark, sf_dir):
    return _shown(cascade.at_least_sentences(t.lang_reviews(spark, sf_dir), 2))


@query
def q12_active_by_median(spark, sf_dir):
    return _shown(t.active_by_median(spark, sf_dir))


@query
def q13_active_by_number(spark, sf_dir):
    return _shown(t.active_by_number(spark, sf_dir))


@query
def q14_top_customers_by_sentences(spark, sf_dir):
    active = t.active_by_number(spark, sf_dir)
    return profile.top_by_median(active, "customer_id", "num_sentences")


@query
def q15_top_products_by_sentences(spark, sf_dir):
    active = t.active_by_number(spark, sf_dir)
    return profile.top_by_median(active, "product_id", "num_sentences")


# Classes, sentences, tokens


@query
def q16_class_split(spark, sf_dir):
    classed = t.classed_reviews(spark, sf_dir)
    return classed.select("sentiment", "review_id", "star_rating", "num_sentences")


@query
def q17_trimmed_sentences(spark, sf_dir):
    return sentences.trimmed_sentences(t.classed_reviews(spark, sf_dir))


@query
def q18_tokens(spark, sf_dir):
    tokenised = t.tokenised(spark, sf_dir)
    return tokenised.select(
        "sentiment",
        "review_id",
        "pos",
        F.size("tokens").alias("num_tokens"),
        F.array_join("tokens", " ").alias("tokens"),
    )


# Sentence vectors, class centres and nearest sentences


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.hashed_vectors(t.classed_sentences(spark, sf_dir), t.VECTOR_SIZE)


def _hashed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scratch.written(centres.unit_vectors(_hashed(spark, sf_dir)), "hashed-units")


@query
def q19_hashed_vectors(spark, sf_dir):
    return embed.long_form(_hashed(spark, sf_dir))


@query
def q20_mean_distances(spark, sf_dir):
    units = _hashed_units(spark, sf_dir)
    return centres.mean_distances(units, groups=sentences.SENTIMENTS)


@query
def q21_class_centres(spark, sf_dir):
    units = _hashed_units(spark, sf_dir)
    return centres.centres(units, groups=sentences.SENTIMENTS)


@query
def q22_nearest_sentences(spark, sf_dir):
    units = _hashed_units(spark, sf_dir)
    return centres.nearest_to_centres(units, groups=sentences.SENTIMENTS)


BLOCKS = 8


def _block_sums(vector: str) -> list:
    """Sums over eight equal stretches of a vector: enough to tell two vectors apart."""
    size = F.size(vector) / BLOCKS

    def block(i: int):
        part = F.slice(vector, (i * size + 1).cast("int"), size.cast("int"))
        return F.aggregate(part, F.lit(0.0), lambda total, x: total + x).alias(f"s{i}")

    return [block(i) for i in range(BLOCKS)]


def _word2vec(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tokenised sentences, their vectors and those of their words, trained by as many tasks as
    run side by side."""
    tokens = t.written_tokens(spark, sf_dir)
    tasks = spark.sparkContext.defaultParallelism
    return tokens, *embed.word2vec(tokens, sentences.SENTIMENTS, num_partitions=tasks)


@query
def q23_word2vec_vectors(spark, sf_dir):
    """Length of each sentence's vector, and whether it is the mean of its words' vectors."""
    tokens, vectors, words = _word2vec(spark, sf_dir)
    key = ["sentiment", "review_id", "pos"]
    names = [f"s{i}" for i in range(BLOCKS)]
    word_sums = words.select("sentiment", "word", *_block_sums("vector"))
    means = (
        tokens.select(*key, F.explode("tokens").alias("word"))
        .join(word_sums, ["sentiment", "word"])
        .groupBy(*key)
        .agg(*[F.avg(name).alias(f"mean_{name}") for name in names])
    )
    near = [F.abs(F.col(name) - F.col(f"mean_{name}")) <= 1e-6 for name in names]
    own = vectors.select(*key, F.size("vector").alias("size"), *_block_sums("vector"))
    return own.join(means, key, "left").select(
        *key, "size", F.coalesce(reduce(and_, near), F.lit(False)).alias("is_mean")
    )


def _of_word2vec(
    spark: SparkSession, sf_dir: str, make: Callable[[DataFrame], DataFrame], **options: str
) -> DataFrame:
    """What is made of each sentence's vector, trained as in ``_word2vec``."""
    return embed.word2vec_rows(
        t.written_tokens(spark, sf_dir),
        sentences.SENTIMENTS,
        make,
        num_partitions=spark.sparkContext.defaultParallelism,
        **options,
    )


def _nearest_units(units: DataFrame) -> DataFrame:
    near = centres.nearest_to_centres(units, groups=sentences.SENTIMENTS)
    return scratch.written(near, "word2vec-nearest")


def _dot(left: str, right: str) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


@query
def q24_word2vec_nearest(spark, sf_dir):
    """Ranks of the ten nearest, and whether they agree with a ranking of all float vectors:
    the centre's mean distance is the least of its class, and the distance at each rank is
    that of all rows of the class, ranked anew."""
    # directions are made of the float vectors as they are read, and written a row per class only
    vectors = _of_word2vec(spark, sf_dir, lambda rows: rows.select("sentiment", *centres.ID, "vector"))
    near = _nearest_units(scratch.written(centres.unit_vectors(vectors), "word2vec-units", compression="zstd"))

    def directions_of(rows: DataFrame) -> DataFrame:
        plain = rows.filter(F.exists("vector", lambda x: x != 0))
        plain = plain.withColumn("plain", array_to_vector("vector"))
        normal = Normalizer(inputCol="plain", outputCol="normal").transform(plain)
        direction = vector_to_array("normal").alias("direction")
        return normal.select("sentiment", "review_id", "pos", direction)

    directions = directions_of(vectors)
    mean = vector_to_array(Summarizer.mean(array_to_vector("direction")))
    means = directions.groupBy("sentiment").agg(mean.alias("mean"))
    means = scratch.written(means, "word2vec-means")
    key = ["sentiment", "centre_review_id", "centre_pos"]
    centre = scratch.written(near.select(*key).distinct(), "word2vec-centre-ids")
    own = centre.toDF("sentiment", *centres.ID)
    of_centre = directions_of(vectors.join(own, ["sentiment", *centres.ID], "left_semi"))
    of_centre = scratch.written(of_centre.toDF(*key, "centre"), "word2vec-centres")
    measured = scratch.written(
        directions.join(means, "sentiment").join(of_centre, "sentiment").select(
            "sentiment",
            (1 - _dot("direction", "mean")).alias("mean_distance"),
            (1 - _dot("direction", "centre")).alias("distance"),
            ((F.col("review_id") == F.col("centre_review_id"))
             & (F.col("pos") == F.col("centre_pos"))).alias("is_centre"),
        ),
        "word2vec-distances",
    )
    least = measured.groupBy("sentiment").agg(
        (F.min("mean_distance") + 1e-6 >= F.max(F.when(F.col("is_centre"), F.col("mean_distance"))))
        .alias("is_least")
    )
    anew = Window.partitionBy("sentiment").orderBy("distance")
    ranked = (
        measured.filter("not is_centre")
        .withColumn("rank", F.row_number().over(anew))
        .filter("rank <= 10")
        .select("sentiment", "rank", F.col("distance").alias("float_distance"))
    )
    agrees = F.col("is_least") & (F.abs(F.col("float_distance") - F.col("distance")) <= 2e-6)
    return (
        near.join(ranked, ["sentiment", "rank"], "left")
        .join(least, "sentiment", "left")
        .select("sentiment", "rank", F.coalesce(agrees, F.lit(False)).alias("agrees"))
    )


# Trending videos


@query
def q25_countries_per_video(spark, sf_dir):
    ratio = trending.countries_per_video(t.branded_videos(spark, sf_dir))
    return ratio.select(
        "category", rounded(F.col("countries_per_video"), 6).alias("countries_per_video")
    )


@query
def q26_countries_per_video_text(spark, sf_dir):
    return trending.countries_per_video_text(t.branded_videos(spark, sf_dir))


@query
def q27_growth(spark, sf_dir):
    return trending.growth(t.videos(spark, sf_dir))


@query
def q28_top_growth(spark, sf_dir):
    return trending.top_growth(t.videos(spark, sf_dir))


@query
def q29_sightings(spark, sf_dir):
    seen = trending.sightings(t.videos(spark, sf_dir))
    return seen.withColumn("trending_date", F.date_format("trending_date", "yyyy-MM-dd"))


# Movies and ratings, tags


@query
def q30_movie_genres(spark, sf_dir):
    return ratings.movie_genres(t.movies(spark, sf_dir))


@query
def q31_average_rating_per_genre(spark, sf_dir):
    average = ratings.average_rating_per_genre(
        t.movies(spark, sf_dir), t.ratings(spark, sf_dir)
    )
    return average.select("genre", rounded(F.col("average_rating"), 6).alias("average_rating"))


@query
def q32_tag_owners(spark, sf_dir):
    return tags.tag_owners(t.photos(spark, sf_dir))


@query
def q33_inverted_list(spark, sf_dir):
    return tags.inverted_list(t.photos(spark, sf_dir))


# Reading and writing text


@query
def q34_line_fields(spark, sf_dir):
    return t.video_fields(t.text_lines(spark, sf_dir))


@query
def q35_rating_lines(spark, sf_dir):
    return readers.parse_ratings(t.rating_lines(spark, sf_dir))


@query
def q36_text_round_trip(spark, sf_dir):
    path = scratch.scratch_path(spark, "countries-per-video")
    result = q26_countries_per_video_text(spark, sf_dir)
    sinks.write_text(result, path, parts=3, key="category")
    schema = "category string, countries_per_video string"
    return spark.read.schema(schema).option("sep", "\t").csv(path)


@query
def q37_review_file(spark, sf_dir):
    """Documents written as a gzipped review file with extra columns, and read again."""
    path = scratch.scratch_path(spark, "reviews")
    reviews = t.review_table(spark, sf_dir)
    columns = reviews.columns
    lines = reviews.write.option("sep", "\t").option("header", True)
    lines.option("compression", "gzip").csv(path)
    return readers.read_reviews(spark, path, columns)


@query
def q38_dates(spark, sf_dir):
    """Order dates as text, broken for open orders, read tolerantly and written again."""
    written = F.date_format("o_orderdate", dates.DAY_MONTH_YEAR)
    broken = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("31."), written))
    orders = t.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.coalesce(broken, written).alias("date_text")
    )
    date = dates.parse_date(F.col("date_text"))
    return orders.select(
        "o_orderkey",
        "date_text",
        F.date_format(date, "yyyy-MM-dd").alias("parsed"),
        dates.format_date(date).alias("formatted"),
    )


# The same with a loaded encoder, and on given vectors


@query
def q39_encoded_vectors(spark, sf_dir):
    every = t.classed_sentences(spark, sf_dir)
    size = t.VECTOR_SIZE
    return embed.long_form(embed.encoded_vectors(every, lambda: load_hash_encoder(size)))


def _label_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = centres.unit_vectors(t.labelled_vectors(spark, sf_dir), "label")
    return scratch.written(units, "label-units")


@query
def q40_label_centres(spark, sf_dir):
    return centres.centres(_label_units(spark, sf_dir), "label")


@query
def q41_label_nearest(spark, sf_dir):
    return centres.nearest_to_centres(_label_units(spark, sf_dir), "label")


# Files of the original layouts, written from the tables and read again


@query
def q42_video_file(spark, sf_dir):
    """A video file with header lines; lines of open items end before the country."""
    path = scratch.scratch_path(spark, "videos")
    t.video_table(spark, sf_dir).write.option("header", True).csv(path)
    seen = trending.sightings(readers.read_videos(spark, path))
    return seen.withColumn("trending_date", F.date_format("trending_date", "yyyy-MM-dd"))


@query
def q43_movie_file(spark, sf_dir):
    """A movie file with quoted commas and quotes, and lines of too many or few fields."""
    path = scratch.scratch_path(spark, "movies")
    t.movie_lines(spark, sf_dir).write.text(path)
    return ratings.movie_genres(readers.read_movies(spark, path))


@query
def q44_photo_file(spark, sf_dir):
    path = scratch.scratch_path(spark, "photos")
    t.photo_lines(spark, sf_dir).write.text(path)
    return tags.tag_owners(readers.read_photos(spark, path))


@query
def q45_inverted_list_pages(spark, sf_dir):
    return tags.inverted_list(t.photos(spark, sf_dir), owners_per_row=10)


@query
def q46_review_layouts(spark, sf_dir):
    """Reviews of two sources in files of two layouts, the ids swapped and a column more in
    the second; each is read by its own."""
    reviews = t.review_table(spark, sf_dir)
    swapped = ["review_id", "marketplace", "customer_id", "vine", "product_id", "star_rating",
               "review_body"]
    parts = [
        (reviews.filter("star_rating >= '1'"), reviews.columns),
        (reviews.filter("not star_rating >= '1'").withColumn("vine", F.lit("N")), swapped),
    ]
    read = []
    for rows, columns in parts:
        path = scratch.scratch_path(spark, "reviews")
        rows.select(columns).write.option("sep", "\t").option("header", True).csv(path)
        read.append(readers.read_reviews(spark, path, columns))
    return read[0].unionByName(read[1])


@query
def q47_video_file_growth(spark, sf_dir):
    """Top growth from a video file in which some dates and likes cannot be read."""
    path = scratch.scratch_path(spark, "videos")
    t.broken_videos(spark, sf_dir).write.option("header", True).csv(path)
    return trending.top_growth(readers.read_videos(spark, path))


@query
def q48_rating_files(spark, sf_dir):
    """Average rating per genre from a movie file and a rating file with bad lines."""
    movies, rated = (scratch.scratch_path(spark, name) for name in ("movies", "ratings"))
    t.movie_lines(spark, sf_dir).write.text(movies)
    t.item_rating_lines(spark, sf_dir).write.text(rated)
    average = ratings.average_rating_per_genre(
        readers.read_movies(spark, movies), readers.read_ratings(spark, rated)
    )
    return average.select("genre", rounded(F.col("average_rating"), 6).alias("average_rating"))


# The same jobs where one file, one key or one order would otherwise need a single task


@query
def q49_gzip_members(spark, sf_dir):
    """The review file of q37 in gzip files of many members each, two or as many as the texts
    fill, read by runs of them."""
    path = scratch.scratch_path(spark, "reviews")
    lines, columns = t.review_lines(spark, sf_dir)
    files = t.pieces(t.text_bytes(spark, sf_dir), t.FILE_BYTES, 2)
    gzip_members.write_lines(lines.repartition(files), path, "\t".join(columns), 1 << 18)
    return readers.read_gzip_reviews(spark, path, columns, 1 << 19)


@query
def q50_positional_zip(spark, sf_dir):
    """Orders in the order of their keys beside orders in that of their prices."""
    orders = t.table(spark, sf_dir, "orders")
    by_key = positions.numbered(orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"])
    priced = orders.select(
        F.col("o_orderkey").alias("priced_orderkey"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )
    by_price = positions.numbered(priced, [F.desc("cents"), "priced_orderkey"])
    return positions.zipped(by_key, by_price)


@query
def q51_exact_quantiles(spark, sf_dir):
    """Quantiles of very many different prices under three keys."""
    items = t.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents")
    )
    found = selection.quantiles(items, "l_returnflag", "cents", (0.0, 0.25, 0.5, 0.9, 1.0))
    return found.withColumn("quantile", rounded(F.col("quantile"), 6))


@query
def q52_folded_average(spark, sf_dir):
    """q31 by functions: a start, a step and a merge."""
    rated = ratings.movie_genres(t.movies(spark, sf_dir)).join(
        t.ratings(spark, sf_dir), "movie_id"
    )
    found = folding.fold_by_key(rated, ["genre"], ["rating"], folding.average())
    return found.select("genre", rounded(F.col("average"), 6).alias("average_rating"))


@query
def q53_folded_growth(spark, sf_dir):
    """q27 by functions: states of the first two sightings."""
    seen = trending.sightings(t.videos(spark, sf_dir))
    growth = folding.fold_by_key(
        seen,
        ["video_id", "country"],
        ["trending_date", "category", "likes", "dislikes"],
        trending.growth_fold(),
    )
    return growth.filter("seen > 1").select("video_id", "growth", "category", "country")


@query
def q54_word2vec_neighbours(spark, sf_dir):
    """The ten nearest themselves: ids, centre and distance, which follow the fitted model."""
    return _nearest_units(_of_word2vec(spark, sf_dir, centres.unit_vectors, compression="zstd"))


@query
def q55_bad_videos(spark, sf_dir):
    """The lines of q47's file that cannot be read, by reason and by the id they begin with."""
    path = scratch.scratch_path(spark, "videos")
    t.broken_videos(spark, sf_dir).write.option("header", True).csv(path)
    bad = quarantine.videos(spark, path).bad
    first = F.substring_index("line", ",", 1).alias("video_id")
    return bad.groupBy("reason", first).agg(F.count("*").alias("lines"))


@query
def q56_bad_ratings(spark, sf_dir):
    """The lines of q48's rating file that cannot be read, and how many there are of all."""
    path = scratch.scratch_path(spark, "ratings")
    t.item_rating_lines(spark, sf_dir).write.text(path)
    found = quarantine.ratings(spark, path)
    movie = F.get(F.split("line", ","), F.lit(1)).alias("movie_id")
    rows = found.bad.groupBy("reason", movie).agg(F.count("*").alias("lines"))
    return rows.select("*", F.lit(found.counts["lines"]).cast("bigint").alias("all_lines"))


@query
def q57_growth_by_arrival(spark, sf_dir):
    """Growth between the first two lines of a key, as they stand in the files."""
    path = scratch.scratch_path(spark, "videos")
    lines = t.table(spark, sf_dir, "lineitem")
    files = t.pieces(lines.count(), t.FILE_ROWS, 4)
    lines = lines.repartitionByRange(files, "l_orderkey", "l_linenumber")
    lines = lines.sortWithinPartitions("l_orderkey", "l_linenumber")
    t.video_table(spark, sf_dir, lines).write.option("header", True).csv(path)
    videos = readers.read_videos(spark, path, arrival=True)
    return trending.growth(videos, readers.ARRIVAL)


@query
def q58_ordered_files(spark, sf_dir):
    """Growth in one order over several files, read back by their names and lines; with the
    number of rows that the manifest gives for all files."""
    path = scratch.scratch_path(spark, "growth")
    videos = t.videos(spark, sf_dir)
    files = t.pieces(videos.count(), t.FILE_ROWS, 3)
    order = [F.desc("growth"), "video_id", "country"]
    sinks.write_ordered(trending.growth(videos), path, order, files)
    lines = gzip_members.read_lines(spark, path)
    placed = positions.numbered(lines, ["path", "start", "number"])
    listed = gzip_members.manifest(spark, path).agg(F.sum("rows")).first()[0]
    return placed.select("position", "value", F.lit(listed).cast("bigint").alias("all_rows"))


@query
def q59_pruned_nearest(spark, sf_dir):
    """q41 from a layout by pivots, of which the search reads a part."""
    units = _label_units(spark, sf_dir)
    layout = pruned.laid_out(units, "label", row_group=1 << 16)
    centre = centres.centre_rows(centres.directed_units(units, "label", None), "label")
    return pruned.nearest_to_centres(layout, centre)
