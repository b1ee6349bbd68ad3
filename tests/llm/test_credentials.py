import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, oracle_rows, spark_rows
from tidemark.llm import credentials, oracle, queries

SCHEMA = "doc_id bigint, text string, spans string, row int, kind string, start int"
NAMES = {
    "assign": ("password|passwd|secret|token|api_?key", "[A-Za-z0-9+/_.=-]", 6),
    "user": ("username|user|login|account|client_?id|access_?key_?id", "[A-Za-z0-9@+_.-]", 3),
    "host": ("hostname|host|endpoint|server", "[A-Za-z0-9:/_.-]", 3),
}
RUNS = {"access": ("AKIA[A-Z0-9]+", 20), "hex": ("[0-9a-f]+", 24), "blob": ("[A-Za-z0-9+/_=-]+", 16)}
URL = "(?:https?|ftp|ssh|s3|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9:/_.@?=&%+~-]+"
ORDER = ["assign", "access", "hex", "user", "blob", "url", "host"]
ROLES = {"assign": "by", "hex": "by", "blob": "by", "access": "who", "user": "who",
         "url": "where", "host": "where"}


def matches(text):
    """Every span of every kind, by plain patterns read from left to right."""
    out = []
    for kind, (names, value, least) in NAMES.items():
        pattern = rf"((?ai:{names}))[\"']?\x20*[:=]\x20*[\"']?({value}+)"
        out += [(m.start(), ORDER.index(kind), m.end(), kind)
                for m in re.finditer(pattern, text) if len(m[2]) >= least]
    for kind, (pattern, least) in RUNS.items():
        for m in re.finditer(pattern, text):
            mixed = all(re.search(c, m[0]) for c in ("[a-z]", "[A-Z]", "[0-9]"))
            if len(m[0]) >= least and (kind != "blob" or mixed):
                out.append((m.start(), ORDER.index(kind), m.end(), kind))
    out += [(m.start(), ORDER.index("url"), m.end(), "url") for m in re.finditer(URL, text)]
    return sorted(out)


def expected(text, reach=credentials.REACH):
    found = matches(text)
    breaks = [m.start() for m in re.finditer(r"\n[ \t]*\n", text)]
    scope = lambda s: sum(b < s for b in breaks)
    parts = [
        a for a in found
        if a[3] != "blob" or not any(b[3] != "blob" and b[0] < a[2] and a[0] < b[2] for b in found)
    ]
    kept = []
    for a in parts:
        partners = [
            b for b in parts
            if (ROLES[a[3]] == "by") != (ROLES[b[3]] == "by") and scope(a[0]) == scope(b[0])
            and max(b[0] - a[2], a[0] - b[2]) <= reach
        ]
        if a[3] in credentials.BASE or partners:
            kept.append(a)
    return kept


def run(spark, texts, **options):
    rows = [(i, t, "x", 1, "y", 2) for i, t in enumerate(texts)]
    found = credentials.digest(credentials.find(spark.createDataFrame(rows, SCHEMA), **options))
    return {r.doc_id: r for r in found.collect()}


def check(row, text, **options):
    kept = expected(text or "", **options)
    written = [f"{k}:{s}:{e}" for s, _, e, k in kept]
    assert row.spans == ",".join(written)
    base = [w for w in written if w.split(":")[0] in credentials.BASE]
    assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
    counts = [sum(w.startswith(k + ":") for w in base) for k in ("assign", "access", "hex")]
    assert [row.n_assign, row.n_access, row.n_hex] == counts


BLOB = "aB3dE6gH9jK2mN5pQ8"
TEXTS = [
    None, "", "password=hunter2", "PassWord : 'hunter2'", "token=abc token = abcdef",
    "token=token:abcdefgh", "apikey=1234567 api_key=\"abcdef=\"", "ſecret=abcdef toKen=abcdef",
    "AKIA" + "A" * 16, "AKIA" + "A" * 15, "xAKIA1AKIA" + "B" * 15, "🙂" + "a" * 24 + "g" + "f" * 23,
    # weak parts alone, and with a complement
    f"{BLOB}", f"user = bob {BLOB}", f"user = bob\n{BLOB}", f"user = bob\n\n{BLOB}",
    f"user = bob\n \t\n{BLOB}", f"user = bob" + " " * 300 + BLOB, "user = bob", "https://a.b/c?d=1",
    f"https://a.b/c user: bob", f"host=db.local {BLOB}", "host=db.local token=abcdefg",
    f"https://a.b/{BLOB} user=carol", f"user={BLOB} {BLOB}", f"é🙂 user=bob é {BLOB} login=ann",
    "AKIA" + "Z" * 20 + " " + BLOB, "user" + " " * 5000 + "x", "password" * 500 + "=" * 500,
    "\n".join(f"user=u{i:03d}" for i in range(200)) + f"\n{BLOB}",
]


def test_fixed_texts(spark):
    found = run(spark, TEXTS)
    for i, text in enumerate(TEXTS):
        check(found[i], text)
    assert found[12].spans == "" and "blob" in found[13].spans and found[15].spans == ""


@pytest.mark.parametrize("reach", [5, 40])
def test_random_texts(spark, reach):
    pick = random.Random(reach)
    words = ["user=", "bob ", "token", "=", ": ", "abcdef", BLOB, " ", "\n", "\n\n", "'", "é", "AKIA",
             "ABCDEFGHIJKLMNOPQ", "0123456789abcdef0123456789", "host=", "https://", "x.y", "_", "-"]
    texts = ["".join(pick.choice(words) for _ in range(pick.randint(1, 60))) for _ in range(400)]
    found = run(spark, texts, reach=reach)
    for i, text in enumerate(texts):
        check(found[i], text, reach=reach)


def test_partners(spark):
    text = f"login=ann {BLOB} user=bob"
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    [row] = credentials.find(df).collect()
    assert [(s.kind, s.role, s.partner) for s in row.spans] == [
        ("user", "identifier", "blob"), ("blob", "secret", "user"), ("user", "identifier", "blob")
    ]
    assert row.spans[1].partner_start == 0 or row.spans[1].partner_start == text.index("user=bob")


def test_repeated_rows_and_missing_ids(spark):
    rows = [(None, "token=abcdef"), (None, "token=abcdef"), (7, None), (7, "token=abcdef")]
    found = credentials.find(spark.createDataFrame(rows, "doc_id bigint, text string"))
    counts = sorted((r.doc_id is None, r.doc_id or 0, len(r.spans)) for r in found.collect())
    assert counts == [(False, 7, 0), (False, 7, 1), (True, 0, 1), (True, 0, 1)]


def test_empty_table(spark):
    found = credentials.digest(credentials.find(spark.createDataFrame([], SCHEMA)))
    assert found.count() == 0
    assert found.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def test_long_text_of_many_spans(spark):
    text = f"user=bob {BLOB} token=abcdefgh\n" * 20_000
    found = run(spark, [text])[0]
    assert found.n_assign == 20_000 and found.spans.count("user:") == 20_000


def test_sql(spark, sf_dir):
    names, rows = spark_rows(queries.op11_secret_scan(spark, sf_dir))
    expected_names, wanted = oracle_rows(connect(sf_dir), oracle.ORACLE["op11_secret_scan"])
    assert names == expected_names and rows == wanted


def test_sql_on_weak_parts(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS) if t is None or "ſ" not in t]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    _, wanted = oracle_rows(con, oracle.ORACLE["op11_secret_scan"])
    _, found = spark_rows(queries.op11_secret_scan(spark, str(tmp_path)))
    assert found == wanted


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "user=bob")], SCHEMA.split(", spans")[0])
    plan = credentials.digest(credentials.find(df.withColumn("x", F.lit(1))))._jdf.queryExecution()
    assert "Python" not in plan.toString() and "Arrow" not in plan.toString()
