import heapq
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import embed, skipgram
from tidemark.plans import queries
from tidemark.plans import tables as t
from tidemark.sources import scratch

SCHEMA = "sentiment string, review_id int, pos int, tokens array<string>"


def plain_cost(counts):
    """Bits of all words in an optimal code: the sum of the weights of all inner nodes."""
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


@pytest.mark.parametrize("seed", range(30))
def test_codes_are_optimal_and_free_of_prefixes(seed):
    pick = random.Random(seed)
    counts = [min(int(pick.paretovariate(0.7)), 10**6) for _ in range(pick.choice([1, 2, 3, 7, 500]))]
    ranges = skipgram.code_ranges(skipgram.code_lengths(dict(Counter(counts))))
    codes = [code + i for _, n, code in ranges for i in range(n)]
    assert len(codes) == len(counts) and [r[0] for r in ranges][0] == 0
    lengths = [c.bit_length() - 1 for c in codes]
    ordered = sorted(counts, reverse=True)
    assert sum(n * bits for n, bits in zip(ordered, lengths, strict=True)) == plain_cost(counts)
    if len(codes) > 1:
        assert sum(2.0**-bits for bits in lengths) == 1.0
        prefixes = {c >> i for c in codes for i in range(1, c.bit_length())}
        assert not prefixes & set(codes)


def test_training_step_is_that_of_the_definition():
    """One pair after the other, as the library does it, apart from what a step itself moves."""
    codes, size, random_ = np.array([2, 6, 7]), 4, np.random.default_rng(3)
    start = random_.random((3, size), np.float32)
    sentence = np.array([0, 1, 2, 1])
    found = start.copy()
    assert skipgram.trained([sentence], codes, found, 5, 0.0).all()
    reach = skipgram.WINDOW - np.random.default_rng(5).integers(0, skipgram.WINDOW, 4)
    syn0, syn1 = start.astype(float), {1: np.zeros(size), 3: np.zeros(size)}
    for place, word in enumerate(sentence):
        for other in range(4):
            if other == place or abs(other - place) > reach[place]:
                continue
            code, change, of = int(codes[word]), np.zeros(size), sentence[other]
            for i in range(code.bit_length() - 1, 0, -1):
                node, bit = code >> i, code >> (i - 1) & 1
                step = skipgram.RATE * (1 - bit - 1 / (1 + np.exp(-syn0[of] @ syn1[node])))
                change += step * syn1[node]
                syn1[node] = syn1[node] + step * syn0[of]
            syn0[of] += change
    assert np.abs(found - start).max() > 0
    assert found == pytest.approx(syn0, abs=2e-3)


@pytest.fixture
def table(spark, tmp_path):
    words = random.Random(4)
    rows = [("ab"[i % 5 == 0], i, 0, [f"w{int(words.paretovariate(0.6)) % 300}" for _ in range(6)])
            for i in range(400)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_fits_of_a_table_are_equal(table):
    """However many tasks train."""
    first, again = (
        {(r.sentiment, r.word): r.vector for r in embed.word2vec(table, ["a", "b"], 6, num_partitions=4)[1].collect()}
        for _ in range(2)
    )
    assert first == again and len({tuple(v) for v in first.values()}) == len(first)


def test_blocks_are_bounded(spark, table, monkeypatch):
    """A task holds the words of some sentences, not those of a class."""
    monkeypatch.setattr(embed, "BLOCK_TOKENS", 300)
    rows = embed._in_blocks(table, ["a", "b"], 1)
    sizes = rows.groupBy("sentiment", "block").agg(F.sum(F.size("tokens")).alias("n")).collect()
    assert len(sizes) >= 8 and max(r.n for r in sizes) < 600
    vectors, words = embed.word2vec(table, ["a", "b"], 6)
    every = {(r.sentiment, w) for r in table.collect() for w in r.tokens}
    assert {(r.sentiment, r.word) for r in words.collect()} == every
    assert vectors.count() == 400


def test_unknown_words_count_in_the_mean(table):
    vectors, words = embed.word2vec(table, ["a"], 6, min_count=30, num_partitions=2)
    known = {r.word: np.array(r.vector) for r in words.collect()}
    tokens = {r.review_id: r.tokens for r in table.filter("sentiment = 'a'").collect()}
    assert 0 < len(known) < 300
    for r in vectors.collect():
        own = tokens[r.review_id]
        mean = sum((known[w] for w in own if w in known), np.zeros(6)) / len(own)
        assert r.vector == pytest.approx(mean, abs=1e-6)


def test_rows_are_made_in_rounds(table, monkeypatch):
    """However few words are moved at a time; the model goes."""
    vectors = embed.word2vec(table, ["a", "b"], 6, num_partitions=4)[0]
    monkeypatch.setattr(embed, "MOVED_BYTES", 2000)
    written = []
    monkeypatch.setattr(
        scratch, "written", lambda *a, f=scratch.written, **k: written.append(f(*a, **k)) or written[-1]
    )
    found = embed.word2vec_rows(table, ["a", "b"], lambda rows: rows, 6, num_partitions=4)
    assert found.schema == vectors.schema and len(found.inputFiles()) > 8
    assert sorted(map(str, found.collect())) == sorted(map(str, vectors.collect()))
    made = [df for df in written if "word2vec-words" in str(df.inputFiles()[:1])]
    with pytest.raises(Exception, match="exist|FAILED_READ_FILE"):
        made[-1].count()


def test_rows_of_no_sentences(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    found = embed.word2vec_rows(nothing, ["a"], lambda rows: rows, 6)
    assert found.columns == ["sentiment", "review_id", "pos", "vector"] and found.count() == 0


def test_moved_words_do_not_stay_on_disk(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def moved():
        return {str(b) for b in disk.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}

    rows = spark.range(1000).repartition(7, "id")
    before = moved()
    with scratch.without_shuffles(spark):
        table = scratch.written(rows, "moved")
    assert not moved() - before and table.count() == 1000
    assert spark.conf.get(scratch.SHUFFLE_CLEANUP, None) != "true"


@pytest.mark.parametrize(
    "name, most", [("q54_word2vec_neighbours", 1.0), ("q24_word2vec_nearest", 2.0)]
)
def test_sentence_vectors_are_written_once(spark, sf_dir, name, most):
    """Bytes of all tables that a query leaves, to those of the vectors of its sentences."""
    folder = Path(scratch._run_folder(spark).removeprefix("file:"))

    def left():
        return sum(f.stat().st_size for f in folder.rglob("*.parquet") if f.is_file())

    before, vectors = left(), t.tokenised(spark, sf_dir).count() * 512 * 8
    assert queries.QUERIES[name](spark, sf_dir).count() == 20
    assert left() - before < most * vectors
