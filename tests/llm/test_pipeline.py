import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as spark_entry
import corpus_pipeline
from tests.llm.test_decontaminate import brute as found_by_brute_force
from tests.llm.test_jaccard_join import brute as clustered_by_brute_force
from tests.llm.test_line_dedup import brute as cleaned_by_brute_force
from tests.llm.test_line_dedup import runs_by_brute_force
from tests.llm.test_packing import checked

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    """The rows that each stage got and gave."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    schema = docs.schema
    out = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        given = spark.read.parquet(f"{folder}/{k}")
        out[name] = (docs.collect(), given.collect())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert given.columns == COLUMNS
            assert [f.dataType for f in given.schema] == [f.dataType for f in schema]
        docs = given
    return out


def test_quality_rejects_and_keeps(steps, spark, sf_dir):
    got, kept = steps["quality classifier"]
    assert set(kept) < set(got)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    left = {r.doc_id for r in kept}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in left for d in good) >= 0.97 * len(good)
    assert sum(d in left for d in bad) <= 0.25 * len(bad)


def test_lines_go_as_brute_force_says(steps):
    """First chunks, then the runs of lines that are counted from the lines alone."""
    got, kept = steps["line dedup"]
    middle = []
    for row, (_, _, chunks, _, left) in zip(got, cleaned_by_brute_force(got), strict=True):
        text, n = (left, len(left)) if chunks else (row.text, row.n_chars)
        middle.append(Row(doc_id=row.doc_id, text=text, n_chars=n))
    before = {r.doc_id: (r.text, r.n_chars) for r in middle}
    expected = {
        r[0]: (r[3], len(r[3])) if r[2] else before[r[0]] for r in runs_by_brute_force(middle)
    }
    assert {r.doc_id: (r.text, r.n_chars) for r in kept} == expected
    assert any(a.text != before[a.doc_id][0] for a in got)
    assert any(expected[a.doc_id] != before[a.doc_id] for a in got)


def test_one_of_each_group_stays(steps):
    got, kept = steps["n-gram Jaccard join"]
    rows = clustered_by_brute_force(got)
    assert {r.doc_id for r in kept} == {r[0] for r in rows if r[0] == r[2]}
    assert set(kept) < set(got)


def test_benchmark_documents_go(steps, spark, sf_dir):
    got, kept = steps["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = found_by_brute_force([(r.doc_id, r.text) for r in got], items, 10)
    assert {r.doc_id for r in kept} == {r[0] for r in rows if not r[5]}


def test_packing_holds_every_token(steps):
    got, pieces = steps["best-fit packing"]
    checked(pieces, 1024)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = defaultdict(list)
    for piece in pieces:
        own[piece.doc_id].append(piece)
    assert set(own) == {r.doc_id for r in got}
    for row in got:
        ids = tokenizer.encode(row.text, add_special_tokens=False).ids + [2]
        for piece in own[row.doc_id]:
            part = np.array(ids[piece.start : piece.start + piece.length], "<u4").tobytes()
            assert piece.ids_crc32 == zlib.crc32(part)
        assert sum(p.length for p in own[row.doc_id]) == len(ids)


def test_run_gives_the_last_stage(steps, spark, sf_dir):
    rows = spark_entry.queries()["pipeline"](spark, sf_dir).collect()
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    picked = lambda rs: sorted(tuple(r[n] for n in names) for r in rs)
    assert picked(rows) == picked(steps["best-fit packing"][1])


def test_odd_tables(spark, sf_dir, tmp_path):
    """Every stage takes empty tables, NULLs, repeated rows and further columns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.limit(30).union(docs.limit(5)).union(
        spark.createDataFrame(
            [(None, None, None, None, None), (10**9, "", "en", "", 0), (10**9, None, "", "", 1)],
            docs.schema,
        )
    )
    for frame in (odd, odd.limit(0)):
        frame = frame.withColumns({"score": F.lit(1), "key": F.lit("k"), "text_left": F.lit(None).cast("string")})
        for name, stage in corpus_pipeline.STAGES:
            given = stage(spark, frame, sf_dir)
            rows = given.collect()
            if name != "best-fit packing":
                assert given.columns == frame.columns and len(rows) <= frame.count()


def test_five_stages_in_the_dealt_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination",
        "best-fit packing",
    ]
