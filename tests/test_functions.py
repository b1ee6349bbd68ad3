import datetime
import re
import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text, vectors


def column(spark, values, build, kind="string"):
    rows = [(i, value) for i, value in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.y for r in df.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


def test_sentences_keep_blank_pieces_and_drop_empty_ones(spark):
    bodies = [None, "", "?!.", "A. . B", "one", "a.b?c!d", " ", "x\ny. z"]
    assert column(spark, bodies, text.sentences) == [
        [], [], [], ["A", " ", " B"], ["one"], ["a", "b", "c", "d"], [" "], ["x\ny", " z"],
    ]


PIECES = st.text(alphabet="ab .?!\n\t_é", max_size=30)


@settings(max_examples=10, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=30))
def test_counts_agree_with_the_lists(spark, bodies):
    found = column(spark, bodies, text.sentences)
    assert found == [[p for p in re.split("[.?!]", b) if p != ""] for b in bodies]
    words = column(spark, bodies, text.tokens)
    assert words == [re.findall(r"\w+", b.lower(), re.ASCII) for b in bodies]
    for least in range(4):
        has = column(spark, bodies, lambda c: text.has_sentences(c, least))
        assert has == [len(f) >= least for f in found]
        has = column(spark, bodies, lambda c: text.has_tokens(c, least))
        assert has == [len(w) >= least for w in words]


def test_counting_reads_a_long_text_once(spark):
    long = ["a" * 2_000_000, "." * 2_000_000, "a b" * 500_000]
    assert column(spark, long, lambda c: text.has_sentences(c, 2)) == [False, False, False]
    assert column(spark, long, lambda c: text.has_tokens(c, 2)) == [False, False, True]


def test_fields_strip_the_line_and_forget_empty_ends(spark):
    lines = [" a,b,,d \r", "a,,,", ",,", "a", "　x,y "]
    assert column(spark, lines, text.fields) == [
        ["a", "b", "", "d"], ["a"], [""], ["a"], ["x", "y"],
    ]
    assert column(spark, ["a|b||"], lambda c: text.fields(c, "|")) == [["a", "b"]]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="a, |\n\t", max_size=20), min_size=1, max_size=40))
def test_has_fields_agrees_with_fields(spark, lines):
    for sep in ",|":
        counts = [len(f) for f in column(spark, lines, lambda c: text.fields(c, sep))]
        for least in (2, 3, 5):
            has = column(spark, lines, lambda c: text.has_fields(c, least, sep))
            assert has == [count >= least for count in counts]


def test_strip_is_pythons(spark):
    odd = [chr(c) + "x" + chr(c) for c in range(0x3100) if not 0xD800 <= c <= 0xDFFF]
    assert column(spark, odd, text.strip) == [line.strip() for line in odd]


def test_ascii(spark):
    assert column(spark, ["dog", "café", ""], text.is_ascii) == [True, False, True]


def test_try_double_takes_what_float_takes(spark):
    good = ["3", " 4.5 ", "1e3", "-.5", "5.", "+2"]
    assert column(spark, good, numbers.try_double) == [float(g) for g in good]
    assert column(spark, ["inf", "-Infinity"], numbers.try_double) == [
        float("inf"), float("-inf"),
    ]
    bad = ["", "x", "1d", "1.0f", "5-LOW", None, "1 2", "0x1p3"]
    assert column(spark, bad, numbers.try_double) == [None] * len(bad)


def test_two_decimals_round_the_binary_value(spark):
    values = [1.125, 1.015, 2.675, 1234567.891, 1.0, 0.5, -0.25, 10.0]
    assert column(spark, values, numbers.two_decimals, "double") == [
        "1.12", "1.01", "2.67", "1234567.89", "1.00", ".50", "-.25", "10.00",
    ]


def test_dates(spark):
    texts = ["14.11.17", "31.12.98", "29.02.96", "31.02.99", "x", "", None, "1998-01-01"]
    day = datetime.date
    assert column(spark, texts, dates.parse_date) == [
        day(2017, 11, 14), day(1998, 12, 31), day(1996, 2, 29), None, None, None, None, None,
    ]
    assert column(spark, ["17.14.11"], lambda c: dates.parse_date(c, "yy.dd.MM")) == [
        day(2017, 11, 14)
    ]
    assert column(spark, ["2098-01-02"], lambda c: dates.parse_date(c, "yyyy-MM-dd")) == [
        day(2098, 1, 2)
    ]
    assert column(spark, [day(2017, 11, 4)], dates.format_date, "date") == ["04.11.17"]


def test_last_day_of_two_digit_years(spark):
    texts = ["31.12.68", "01.01.69", "05.06.30"]
    assert column(spark, texts, dates.parse_date) == [
        datetime.date(2068, 12, 31), datetime.date(1969, 1, 1), datetime.date(2030, 6, 5),
    ]
    latest = datetime.date(2029, 12, 31)
    assert column(spark, texts, lambda c: dates.parse_date(c, latest=latest)) == [
        datetime.date(1968, 12, 31), datetime.date(1969, 1, 1), datetime.date(1930, 6, 5),
    ]


def test_exact_dot(spark):
    rows = [([1 << 31, -3], [1 << 31, 5]), ([0, 2], [7, 0])]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    found = [r[0] for r in df.select(vectors.exact_dot("a", "b")).collect()]
    assert found == [(1 << 62) - 15, 0]
    assert df.limit(0).select(vectors.exact_dot("a", "b")).count() == 0


def test_dates_do_not_move_with_the_time_zone(spark, conf):
    conf("spark.sql.session.timeZone", "Pacific/Auckland")
    day = datetime.date(2017, 11, 14)
    assert column(spark, ["14.11.17"], dates.parse_date) == [day]
    assert column(spark, [day], dates.format_date, "date") == ["14.11.17"]


def test_bucket_is_the_head_of_the_md5(spark):
    assert column(spark, ["abc"], lambda c: text.bucket(c, 64)) == [24]
    spread = column(spark, list(string.ascii_letters), lambda c: text.bucket(c, 8))
    assert set(spread) == set(range(8))


def test_rounded_has_no_negative_zero(spark):
    values = column(spark, [-0.0, -1e-12, 0.1234567], lambda c: vectors.rounded(c, 6), "double")
    assert [str(x) for x in values] == ["0.0", "0.0", "0.123457"]
