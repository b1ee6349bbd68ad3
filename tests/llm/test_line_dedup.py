import hashlib
import random

import pytest

from tests.compare import connect, oracle_rows, spark_rows
from tidemark.llm import line_dedup, oracle, queries

SCHEMA = "doc_id bigint, text string, n_chars int, _text string, marks string, chunks int"


def line_hash(line):
    return int(hashlib.md5(line.encode()).hexdigest()[:7], 16)


def cut(text, rolling=2, spacing=3):
    """First and end line of each chunk."""
    lines = text.split("\n")
    hashes = [line_hash(line) for line in lines]
    out, begin = [], 0
    for i in range(len(lines)):
        code = sum(31**b * hashes[i - b] for b in range(rolling) if i >= b)
        if code % spacing == 0 or i == len(lines) - 1:
            out.append((begin, i + 1))
            begin = i + 1
    return lines, out


def brute(rows, **options):
    found = []
    for r in rows:
        text = r[1] or ""
        lines, spans = cut(text, **options)
        rid = -(1 << 63) if r[0] is None else r[0]
        for k, (begin, end) in enumerate([s for s in spans if s[1] - s[0] >= 2]):
            name = (rid, hashlib.md5(text.encode()).hexdigest(), k)
            found.append(("\n".join(lines[begin:end]), name, begin, end))
    first = {}
    for chunk, name, *_ in found:
        first[chunk] = min(first.get(chunk, name), name)
    out = []
    for r in rows:
        text = r[1] or ""
        own = (-(1 << 63) if r[0] is None else r[0], hashlib.md5(text.encode()).hexdigest())
        gone = {(b, e) for chunk, n, b, e in found if n[:2] == own and first[chunk] != n}
        lines = text.split("\n")
        dropped = {i for b, e in gone for i in range(b, e)}
        left = "\n".join(line for i, line in enumerate(lines) if i not in dropped)
        n_lines = 0 if r[1] is None else len(lines)
        out.append((r[0], n_lines, len(gone), len(dropped), left))
    return out


def corpus(seed, n):
    pick = random.Random(seed)
    passages = [[f"p{i} {j}" for j in range(pick.randint(2, 9))] for i in range(4)]
    rows = []
    for _ in range(n):
        lines = []
        for _ in range(pick.randint(0, 4)):
            lines += pick.choice(passages) if pick.random() < 0.5 else [
                pick.choice(["é", "", "x", "same line", str(pick.random())])
                for _ in range(pick.randint(0, 5))
            ]
        rows.append((pick.randrange(n), "\n".join(lines), 3, "a", None, 1))
    return rows + [(1, None, 0, "", "", 0), (None, "\n\n", 2, "", "", 0), (None, "", 0, "", "", 0)]


def digest(rows):
    return sorted(
        ((*r[:4], hashlib.sha256(r[4].encode()).hexdigest()) for r in rows), key=repr
    )


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"rolling": 3, "spacing": 2})])
def test_against_brute_force(spark, seed, options):
    rows = corpus(seed, 150)
    found = line_dedup.find(spark.createDataFrame(rows, SCHEMA), **options)
    expected = digest(brute(rows, **options))
    assert sum(r[2] for r in expected) > 20
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected


def test_remove_gives_back_all_columns(spark):
    rows = corpus(3, 80)
    frame = spark.createDataFrame(rows, SCHEMA)
    cleaned = line_dedup.remove(frame)
    assert cleaned.schema.names == frame.schema.names
    expected = [
        (r[0], r[1] if not b[2] else b[4], r[2] if not b[2] else len(b[4]), *r[3:])
        for r, b in zip(rows, brute(rows), strict=True)
    ]
    assert sorted((tuple(r) for r in cleaned.collect()), key=repr) == sorted(expected, key=repr)


def test_boundaries_move_with_the_lines():
    passage = [f"line {i}" for i in range(40)]
    _, alone = cut("\n".join(passage))
    _, shifted = cut("\n".join(["a", "b", "c", *passage]))
    assert {(b + 3, e + 3) for b, e in alone[2:]} <= set(shifted)


def test_copies_and_a_hot_chunk(spark):
    lines = "\n".join(f"l{i}" for i in range(12))
    rows = [(i, lines if i % 3 else f"{i}\n{lines}", 0, "", "", 0) for i in range(60)]
    rows.append((5, "word\n" * 20_000, 0, "", "", 0))
    found = line_dedup.find(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == digest(brute(rows))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert line_dedup.find(none).count() == 0 and line_dedup.remove(none).count() == 0


def test_no_python(spark, sf_dir):
    plan = queries.op1_line_dedup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_query_equals_sql(spark, sf_dir):
    _, rows = spark_rows(queries.op1_line_dedup(spark, sf_dir))
    assert rows == oracle_rows(connect(sf_dir), oracle.ORACLE["op1_line_dedup"])[1]


def places(rows, size=2):
    """Where each sequence of lines stands, in order; rows of equal id and text are one."""
    docs = {}
    for r in rows:
        text = r[1] or ""
        rid = -(1 << 63) if r[0] is None else r[0]
        docs[rid, hashlib.md5(text.encode()).hexdigest()] = text.split("\n")
    found = {}
    for name in sorted(docs):
        lines = docs[name]
        for i in range(len(lines) - size + 1):
            found.setdefault(tuple(lines[i : i + size]), []).append((name, i))
    return docs, found


def runs_by_brute_force(rows, size=2):
    docs, found = places(rows, size)
    gone = {n: set() for n in docs}
    for _, *others in found.values():
        for name, i in others:
            gone[name].update(range(i, i + size))
    out = []
    for r in rows:
        text = r[1] or ""
        name = (-(1 << 63) if r[0] is None else r[0], hashlib.md5(text.encode()).hexdigest())
        drop = gone[name]
        left = "\n".join(x for i, x in enumerate(docs[name]) if i not in drop)
        out.append((r[0], 0 if r[1] is None else len(docs[name]), len(drop), left))
    return out


def run_digest(rows):
    return sorted(((*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in rows), key=repr)


@pytest.mark.parametrize("seed, size", [(1, 2), (2, 3), (3, 1)])
def test_runs_against_brute_force(spark, seed, size):
    rows = corpus(seed, 150)
    rows += rows[:5] + [(7, "word\n" * 2_000, 0, "", "", 0), (8, "a\nb\n" * 9, 0, "", "", 0)]
    found = line_dedup.find_runs(spark.createDataFrame(rows, SCHEMA), size).collect()
    expected = run_digest(runs_by_brute_force(rows, size))
    assert sum(r[2] for r in expected) > 100
    assert sorted((tuple(r) for r in found), key=repr) == expected


def passages(seed, n_passages=60):
    """Each passage of two to five lines once in a document of its own lines, twice in others."""
    pick = random.Random(seed)
    rows = []
    for p in range(n_passages):
        passage = [f"passage {p} line {j}" for j in range(2 + p % 4)]
        for copy in range(3):
            own = [[f"{p} {copy} {side} {pick.random()}" for _ in range(pick.randint(1, 6))]
                   for side in "ab"]
            rows.append((len(rows), "\n".join(own[0] + passage + own[1]), 0, "", "", 0))
    return rows


def test_recall_on_repeated_runs(spark):
    """Counted from the lines alone: no run of two lines is left twice, none is lost."""
    rows = passages(5)
    frame = spark.createDataFrame(rows, SCHEMA)
    _, before = places(rows)
    _, after = places([tuple(r) for r in line_dedup.remove_runs(frame).collect()])
    repeated = {run for run, at in before.items() if len(at) > 1}
    assert len(repeated) == sum(1 + p % 4 for p in range(60))
    assert all(len(after[run]) == 1 for run in repeated)
    _, by_chunks = places([tuple(r) for r in line_dedup.remove(frame).collect()])
    assert sum(len(by_chunks.get(run, [])) > 1 for run in repeated) > len(repeated) / 2


def test_remove_runs_gives_back_all_columns(spark):
    rows = corpus(3, 80)
    frame = spark.createDataFrame(rows, SCHEMA)
    cleaned = line_dedup.remove_runs(frame)
    assert cleaned.schema.names == frame.schema.names
    expected = [
        (r[0], r[1] if not b[2] else b[3], r[2] if not b[2] else len(b[3]), *r[3:])
        for r, b in zip(rows, runs_by_brute_force(rows), strict=True)
    ]
    assert sorted((tuple(r) for r in cleaned.collect()), key=repr) == sorted(expected, key=repr)
    lines = lambda rs: {line for r in rs for line in (r[1] or "").split("\n")}
    assert lines(expected) | {""} == lines(rows) | {""}


def test_runs_of_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert line_dedup.find_runs(none).count() == 0 and line_dedup.remove_runs(none).count() == 0


def test_query_of_runs(spark, sf_dir):
    found = queries.op1_line_runs(spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in found.collect()), key=repr) == run_digest(
        runs_by_brute_force(docs)
    )
