import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fitting, language_id, quality, queries, toxicity

ODD = "doc_id bigint, text string, n_chars bigint, lang string, score string, held_out int"
ROWS = [
    (1, None, None, None, "", 3), (1, None, None, None, "", 3), (2, "", 0, "en", None, None),
    (None, "Some words here.", 16, "en", "", 0), (3, "word " * 40_000, 200_000, "en", "", 0),
    (4, " \n\t ", -5, "fr", "", 0), (5, "12 34 !!", 8, None, "", 0), (6, "日本語 é 🙂", 8, "ja", "", 0),
]


def auc(scores, labels):
    order = np.argsort(scores)
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    positive = labels == 1
    n = positive.sum()
    return (rank[positive].sum() - n * (n + 1) / 2) / (n * (~positive).sum())


@pytest.fixture(scope="module")
def larger(sf_dir):
    return sf_dir.replace("sf0.001", "sf0.01")


def held_out(spark, folder, found, label, divisor, remainder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = found.join(labels, "doc_id").collect()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % divisor == remainder)
    own = [r for r in rows if r.held_out]
    return np.array([r.score for r in own]), np.array([r[label] for r in own]), own


def test_quality_on_held_out_rows(spark, larger):
    found = queries.op9_quality_classifier(spark, larger)
    assert found.count() == spark.read.parquet(f"{larger}/documents.parquet").count()
    scores, labels, rows = held_out(spark, larger, found, "quality", 5, 0)
    assert auc(scores, labels) > 0.97
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_toxicity_on_held_out_rows(spark, sf_dir):
    """Junk documents are labelled without regard to their words here, and are left out."""
    folder = sf_dir.replace("sf0.001", "sf0.1")
    good = spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").select("doc_id")
    found = queries.op5_toxicity(spark, folder).join(good, "doc_id", "left_semi")
    scores, labels, rows = held_out(spark, folder, found, "toxic", 3, 1)
    assert auc(scores, labels) > 0.99
    assert (scores[labels == 0] >= 0.7).mean() < 0.01
    assert (scores[labels == 1] >= 0.7).mean() > 0.9
    chars = spark.read.parquet(f"{folder}/documents.parquet").filter("n_chars > 3000")
    long = {r.doc_id for r in chars.select("doc_id").collect()}
    is_long = np.array([r.doc_id in long for r in rows])
    assert (scores[(labels == 0) & is_long] >= 0.7).mean() < 0.01  # length adds no alarms
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def test_languages_of_held_out_rows(spark, larger):
    found = queries.op7_language_id(spark, larger)
    documents = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang")
    rows = found.join(documents, "doc_id").filter("held_out").collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_other_columns_do_not_change_scores(spark, sf_dir):
    """Language, source and doc_id are no inputs."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    changed = documents.withColumns(
        {"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "doc_id": F.col("doc_id") + 7}
    )
    model = quality.fit(documents, labels, 50)
    toxic = toxicity.fit(documents, labels, 50)
    profiles = language_id.fit(documents, 50)
    for score in (
        lambda d: quality.score(d, model), lambda d: toxicity.score(d, toxic),
        lambda d: language_id.predict(d, profiles),
    ):
        first = {r.doc_id: r.score for r in score(documents).collect()}
        second = {r.doc_id - 7: r.score for r in score(changed).collect()}
        assert first == second


def small_models(spark):
    rows = [(i, "good plain words here" if i % 2 else "BAD!! stuff!! idiot", 20, "en" if i % 2 else "de")
            for i in range(60)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, lang string")
    labels = spark.createDataFrame(
        [(i, i % 2, 1 - i % 2) for i in range(60)] + [(None, 1, 1), (1, None, None)],
        "doc_id bigint, quality int, toxic int",
    )
    return documents, labels


def test_odd_rows(spark):
    documents, labels = small_models(spark)
    odd = spark.createDataFrame(ROWS, ODD)
    for found in (
        quality.score(odd, quality.fit(documents, labels)),
        toxicity.score(odd, toxicity.fit(documents, labels)),
    ):
        rows = found.collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 1}) == 1
    rows = language_id.predict(odd, language_id.fit(documents)).collect()
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (1, 2, 4, 5)} == dict.fromkeys(
        (1, 2, 4, 5), "und"
    )
    assert {r.lang_pred for r in rows} <= {"und", "en", "de"}


def test_empty_tables(spark):
    documents, labels = small_models(spark)
    none, no_labels = documents.limit(0), labels.limit(0)
    assert quality.score(none, quality.fit(none, no_labels)).count() == 0
    assert quality.score(documents, quality.fit(documents, no_labels)).count() == 60
    assert toxicity.score(none, toxicity.fit(documents, labels)).count() == 0
    assert toxicity.score(documents, toxicity.fit(none, labels)).count() == 60
    assert {r.lang_pred for r in language_id.predict(documents, language_id.fit(none)).collect()} == {
        "und"
    }


def test_keep_gives_the_rows_it_got(spark):
    documents, labels = small_models(spark)
    documents = documents.withColumn("score", F.lit("x"))
    model = quality.fit(documents, labels)
    kept = quality.keep(documents, model)
    good = {r.doc_id for r in quality.score(documents, model).filter("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == good == set(range(1, 60, 2))
    assert kept.schema == documents.schema


def test_sum_of_squares_equals_all_pairs():
    dice = np.random.default_rng(1)
    model = quality.train([], [], np.zeros(0))
    model["w"] = dice.standard_normal(model["w"].shape).astype(np.float32)
    model["v"] = dice.standard_normal(model["v"].shape).astype(np.float32)
    starts, keys, x = quality.features(
        [b"some words and some more", b"", b"x"], [3, None, 9], fitting.Numbers(quality.bucket)
    )
    z, _ = quality.forward(model, starts, keys, x)
    for row in range(3):
        own = range(starts[row], starts[row + 1])
        expected = model["w0"][0] + sum(model["w"][keys[i]] * x[i] for i in own)
        expected += sum(
            model["v"][keys[i]] @ model["v"][keys[j]] * x[i] * x[j] for i in own for j in own if i < j
        )
        assert abs(z[row] - expected) < 1e-2


def test_words_with_shared_grams_share_buckets():
    words = ["pathetic", "pathetics", "window"]
    grams, starts = toxicity.subwords(words)
    bags = [set(part.tolist()) for part in np.split(grams, starts[1:])]
    assert len(bags[0] & bags[1]) > 0.6 * len(bags[0]) and len(bags[0] & bags[2]) < 3
    alone, _ = toxicity.subwords(["pathetic"])
    assert set(alone.tolist()) == bags[0]


def test_unseen_misspellings_score_higher():
    pick = random.Random(3)
    clean = ["the", "of", "river", "stone", "green", "walk", "house", "light"]
    texts, labels = [], []
    for i in range(400):
        words = [pick.choice(clean) for _ in range(30)]
        if i % 4 == 0:
            words[pick.randrange(30)] = pick.choice(["pathetic", "worthless", "disgusting"])
        texts.append(" ".join(words).encode())
        labels.append(float(i % 4 == 0))
    scorer = toxicity.Scorer(toxicity.train(texts, None, np.array(labels, np.float32)))
    scores = scorer([b"river pathetlc stone", b"the worthles walk", b"green house light stone"])
    assert scores[0] > 0.5 and scores[1] > 0.5 and scores[2] < 0.2


def test_bound_trigrams_are_nearly_orthogonal():
    first, second = (language_id.bound((a << 42) | (98 << 21) | c).astype(int) for a, c in ((97, 99), (99, 97)))
    assert abs(first @ second) < 200 and first @ first == language_id.DIMENSIONS
