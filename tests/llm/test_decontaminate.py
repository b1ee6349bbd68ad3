import hashlib
import random
import re

import numpy as np
import pytest

from tests.compare import connect, oracle_rows, spark_rows
from tidemark.llm import decontaminate, oracle, queries

SCHEMA = "doc_id bigint, text string, n_hit string, items string"
BENCH = "item_id bigint, text string, doc_id int"


def split(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(documents, items, window):
    out = []
    for doc_id, text, *_ in documents:
        words, hit, ids, longest = split(text), set(), set(), 0
        for item_id, item, *_ in items:
            own = split(item)
            n = min(len(own), window)
            for j in range(len(own) - n + 1) if n else []:
                for i in range(len(words) - n + 1):
                    if words[i : i + n] == own[j : j + n]:
                        hit.update(range(i, i + n))
                        ids.add("null" if item_id is None else str(item_id))
                        k = n
                        while i + k < len(words) and j + k < len(own) and words[i + k] == own[j + k]:
                            k += 1
                        longest = max(longest, k)
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(ids), digest, bool(hit), longest))
    return sorted(out, key=repr)


def run(spark, documents, items, **options):
    found = decontaminate.matches(
        spark.createDataFrame(documents, SCHEMA), spark.createDataFrame(items, BENCH), **options
    )
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest"]
    return sorted((tuple(r) for r in found.select(columns).collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_against_brute_force(spark, block_bytes):
    pick = random.Random(5)
    some = lambda n: " ".join(pick.choice("ab cd éf g".split()) for _ in range(n))
    items = [(i, some(pick.randint(0, 9)), 0) for i in range(12)]
    items += [(None, "Zed, zed!", 1), (3, "cd cd Cd-cd", 1), (50, None, 1), (51, "...", 1)]
    documents = [(i, some(pick.randint(0, 60)), "x", None) for i in range(40)]
    documents += [(1, "zed  ZED", None, None), (None, None, None, None), (7, "", "", "")]
    documents += [(7, "ab " * 5000, "", ""), (7, "ab " * 5000, "", "")]
    assert run(spark, documents, items, window=4, block_bytes=block_bytes) == brute(
        documents, items, 4
    )


def test_longest_match_and_place(spark):
    documents = [(1, "x y one two three four five z", "", "")]
    items = [(9, "zero one two three four five six", 0)]
    found = decontaminate.matches(
        spark.createDataFrame(documents, SCHEMA), spark.createDataFrame(items, BENCH), window=3
    ).first()
    assert (found.longest, found.longest_start, found.longest_item) == (5, 2, "9")


def test_matches_do_not_cross_documents(spark):
    documents = [(1, "one two", "", ""), (2, "three four", "", "")]
    items = [(9, "one two three", 0)]
    assert [r[5] for r in run(spark, documents, items, window=3)] == [False, False]


@pytest.mark.parametrize("items", [[], [(1, None, 0)], [(1, " ?", 0)]])
def test_nothing_to_look_for(spark, items):
    documents = [(1, "one two", "", ""), (2, None, "", "")]
    assert [r[1:4] for r in run(spark, documents, items)] == [(2, 0, 0), (0, 0, 0)]
    frame = spark.createDataFrame(documents, SCHEMA)
    assert decontaminate.remove(frame, spark.createDataFrame(items, BENCH)).count() == 2


def test_remove_keeps_rows_and_columns(spark):
    documents = [(1, "a b c d", "n", None), (1, "q", None, "m"), (None, "z a b c", "", "")]
    frame = spark.createDataFrame(documents, SCHEMA)
    kept = decontaminate.remove(frame, spark.createDataFrame([(1, "a b c", 0)], BENCH))
    assert [tuple(r) for r in kept.collect()] == [documents[1]]
    assert kept.schema == frame.schema
    assert decontaminate.remove(frame.limit(0), spark.createDataFrame([], BENCH)).count() == 0


def test_suffixes_are_sorted():
    numbers = np.array([3, 1, 2, 0, 1, 2, 3, 0, 2, 1, 1, 0, 0, 0, 0], np.uint32)
    places, _ = decontaminate.suffix_array(numbers, 3, 2)
    suffixes = [tuple(numbers[p : p + 3]) for p in places]
    assert suffixes == sorted(suffixes) and len(places) == 6


def test_query_equals_sql(spark, sf_dir):
    _, rows = spark_rows(queries.op4_benchmark_decontamination(spark, sf_dir))
    assert rows == oracle_rows(connect(sf_dir), oracle.ORACLE["op4_benchmark_decontamination"])[1]
