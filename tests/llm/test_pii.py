import hashlib
import random
import re

import pytest

from tests.compare import connect, oracle_rows, spark_rows
from tidemark.llm import oracle, pii, queries

SCHEMA = "doc_id bigint, text string, spans string, found int, start string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def run(spark, texts):
    rows = [(i, t, "x", 1, None) for i, t in enumerate(texts)]
    found = pii.digest(pii.find(spark.createDataFrame(rows, SCHEMA))).collect()
    return {r.doc_id: r for r in found}


def check(row, text):
    expected = base_spans(text or "")
    assert row.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()
    kept = [s for s in row.spans.split(",") if s.split(":")[0] in PATTERNS]
    assert kept == expected
    counts = [sum(s.startswith(k + ":") for s in expected) for k in PATTERNS]
    assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts


TEXTS = [
    None, "", "a@b.c@d.e f@g", "x.y+z@mail-1.example.com.", "a@b.c_x@d.e.f", "@a.b a@.b a@b. é@x.yy",
    "é🙂 1.2.3.4 and 256.1.1.1 or 1.2.3.4.5.6.7.8 0001.02.3.255 00000000000000000000255.1.1.1 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 4111  1111", "5500005555555559 1",
    "+1 (375) 555-4393 +44 20 7946 0958, +1+23456789012 +123 +1 23456789012345678901 +1 ((((",
    "🙂" * 50 + "q@w.ee", "+4111 1111 1111 1111", "1" * 16, "0" * 17 + "-" + "0" * 2,
]


def test_base_spans(spark):
    found = run(spark, TEXTS)
    for i, text in enumerate(TEXTS):
        check(found[i], text)


def test_random_texts(spark):
    pick = random.Random(6)
    letters = "ab.@+-1234 05().é,\n"
    texts = ["".join(pick.choice(letters) for _ in range(pick.randint(1, 120))) for _ in range(600)]
    found = run(spark, texts)
    for i, text in enumerate(texts):
        check(found[i], text)


def test_very_long_runs(spark):
    """The plain patterns take quadratic time over these; the operator's do not."""
    texts = ["a" * 300_000, "1" * 300_000, "1 " * 150_000, "+1" + " " * 300_000, "a@" * 100_000,
             "A1" * 150_000]
    found = run(spark, texts)
    assert all(found[i].spans == "" for i in range(len(texts)))
    many = "q@w.ee " * 3_000 + "1." * 8_000
    found = run(spark, [many])[0]
    assert (found.n_email, found.n_ip) == (3_000, 2_000)
    check(found, many)


@pytest.mark.parametrize(
    "text, spans",
    [
        ("IBAN DE89 3704 0044 0532 0130 00.", "iban:5:32"),
        ("GB82WEST12345698765432", "iban:0:22"),
        ("GB82WEST12345698765431", ""),
        ("his ssn: 123-45-6789", "ssn:9:20"),
        ("no words 123-45-6789", ""),
        ("ssn 000-45-6789 ssn 1-123-45-6789", ""),
        ("password=e3b3ed3cc8548923d6 x", "secret:9:27"),
        ('token = "0641917ea4e9feb9cda8"', "secret:9:29"),
        ("the 0641917ea4e9feb9cda8 token", ""),
    ],
)
def test_checksums_and_context_add_spans(spark, text, spans):
    found = run(spark, [text])[0].spans
    assert ",".join(s for s in found.split(",") if s.split(":")[0] not in PATTERNS) == spans


def test_scores_follow_context(spark):
    rows = [(1, "card 4111111111111111", "", 0, ""), (2, "4111111111111111", "", 0, "")]
    found = pii.find(spark.createDataFrame(rows, SCHEMA)).collect()
    scores = {r.doc_id: r.spans[0].score for r in found}
    assert scores[1] > scores[2] >= pii.THRESHOLD


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_no_python(spark, sf_dir):
    plan = queries.op6_personal_data(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_query_equals_sql(spark, sf_dir):
    _, rows = spark_rows(queries.op6_personal_data(spark, sf_dir))
    assert rows == oracle_rows(connect(sf_dir), oracle.ORACLE["op6_personal_data"])[1]
