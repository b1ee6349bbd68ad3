import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tests.compare import connect, oracle_rows, spark_rows
from tidemark.llm import importance, oracle, queries
from tidemark.sources import scratch

SCHEMA = "doc_id bigint, text string, weight string, rank int, row int"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def expected(documents, target, size=1, buckets=10_000, min_words=20, percent=10):
    def features(text):
        found = words(text)
        grams = [
            " ".join(found[i : i + n]) for n in range(1, size + 1) for i in range(len(found) - n + 1)
        ]
        return [zlib.crc32(g.encode()) % buckets for g in grams]

    s = Counter(b for _, text in documents for b in features(text))
    t = Counter(b for text in target for b in features(text))
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(
            1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))
        )

    rows = []
    for doc_id, text in documents:
        found = features(text)
        weight = math.floor(sum(map(gain, found)) / len(found)) if found else 0
        name = f"2024:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, weight + noise, len(words(text))])
    able = [r for r in rows if r[4] >= min_words]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): i + 1 for i, r in enumerate(able[: len(able) * percent // 100])}
    return sorted(map(str, [(*r[:4], ranks.get(id(r))) for r in rows]))


def corpus(n, seed=3):
    pick = random.Random(seed)
    vocabulary = ["a", "B", "été", "x9", "🙂", "the", "İ", "end"] + [f"w{i}" for i in range(300)]
    docs = []
    for i in range(n):
        text = pick.choice([" ", ", ", "\n"]).join(
            pick.choices(vocabulary, k=pick.choice([0, 3, 19, 20, 21, 60]))
        )
        docs.append((pick.choice([i, -i, i << 40]), text))
    return docs + [(n + 1, None), (n + 2, ""), (n + 3, "x " * 30_000)]


def run(spark, documents, target, **options):
    rows = [(i, t, "w", 1, 2) for i, t in documents]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    other = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.draw(df, other, **options)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(str(tuple(r)) for r in found.collect())


@pytest.mark.parametrize(
    "options",
    [{}, {"chunk": 7, "bits": 3}, {"size": 2, "percent": 60, "chunk": 50}, {"percent": 100, "min_words": 0}],
)
def test_brute_force(spark, options):
    documents = corpus(250)
    target = ["the end of w1 w2 w3", None, "W1, été"]
    plain = {k: v for k, v in options.items() if k not in ("chunk", "bits")}
    assert run(spark, documents, target, **options) == expected(documents, target, **plain)


def test_wide_and_missing_ids(spark):
    documents = [(-(1 << 63), "a " * 20), ((1 << 63) - 1, "a " * 21), (None, "b " * 25), (0, "c " * 20)]
    found = run(spark, documents, [], percent=100)
    assert found == expected(documents, [], percent=100)


def test_no_documents_and_no_target(spark):
    assert run(spark, [], ["a"]) == []
    assert run(spark, [(1, "a b")], []) == expected([(1, "a b")], [])


def test_repeated_rows(spark):
    documents = [(5, "a b " * 10)] * 6 + [(6, "c " * 20)] * 4
    found = run(spark, documents, ["c"], percent=50)
    ranks = sorted(r.rsplit(", ", 1)[1] for r in found)
    assert ranks == ["1)", "2)", "3)", "4)", "5)", "None)", "None)", "None)", "None)", "None)"]


@pytest.mark.parametrize("chunk, bits", [(1, 16), (3, 1), (10, 5), (1000, 11)])
def test_radix_sort(spark, chunk, bits):
    pick = random.Random(chunk)
    top = pick.choice([8, 1 << 20, 1 << 62])
    keys = [(pick.randint(-5, 5), pick.choice([None, pick.randint(-top, top)])) for _ in range(200)]
    rows = [(a, b, i) for i, (a, b) in enumerate(keys)]
    table = scratch.written(spark.createDataFrame(rows, "a bigint, b bigint, row bigint"), "keys")
    found = {r["row"]: r["rank"] for r in importance.ranked(table, ("a", "b"), chunk, bits).collect()}
    assert sorted(found.values()) == list(range(1, 201))
    order = sorted(range(200), key=found.__getitem__)
    placed = [(keys[i][0], keys[i][1] is None, keys[i][1] or 0) for i in order]
    assert placed == sorted(placed)


def test_chunks_hold_no_more_than_asked(spark):
    rows = scratch.written(spark.range(1000).selectExpr("id % 3 a", "0L b", "id row"), "keys")
    chunks = importance._chunked(rows.selectExpr("a high", "b low", "row"), 64)
    for shift in (0, 2):
        chunks = scratch.written(importance._pass(chunks, "high", shift, 0, 64, 2), "pass")
        sizes = [len(r["row"]) for r in chunks.orderBy("chunk").collect()]
        assert sizes == [64] * 15 + [40]


def test_sql(spark, sf_dir):
    names, rows = spark_rows(queries.op12_importance_resampling(spark, sf_dir))
    sql = oracle.ORACLE["op12_importance_resampling"]
    expected_names, wanted = oracle_rows(connect(sf_dir), sql)
    assert names == expected_names and rows == wanted
