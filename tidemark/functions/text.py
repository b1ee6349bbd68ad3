"""Splitting and cleaning text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a sentence is made of, what a token is made of, what is not ASCII.
# A sentence is a run of characters other than the three that end one.
NOT_END, END = r"[^.?!]", r"[.?!]"
WORD, NOT_WORD = r"\w", r"\W"
NON_ASCII = r"[^\x00-\x7F]"
# Every character that Unicode or ASCII calls white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _runs(column: Column, inside: str) -> Column:
    return F.regexp_extract_all(column, F.lit(f"{inside}+"), F.lit(0))


def _has_runs(column: Column, inside: str, outside: str, least: int) -> Column:
    """Whether there are at least that many runs; stops reading the text at the last one.

    Anchored and without backtracking, so that a text of any length is read once.
    """
    if least < 1:
        return F.lit(True)
    return column.rlike(rf"\A{outside}*+(?:{inside}++{outside}++){{{least - 1}}}{inside}")


def sentences(body: Column) -> Column:
    """The text between sentence ends. Empty pieces go, blank ones stay; NULL gives []."""
    return F.coalesce(_runs(body, NOT_END), F.array().cast("array<string>"))


def has_sentences(body: Column, least: int) -> Column:
    return _has_runs(body, NOT_END, END, least)


def tokens(sentence: Column) -> Column:
    """Lower-cased runs of ASCII word characters."""
    return _runs(F.lower(sentence), WORD)


def has_tokens(sentence: Column, least: int) -> Column:
    return _has_runs(F.lower(sentence), WORD, NOT_WORD, least)


def strip(line: Column) -> Column:
    """Cut white space of any kind from both ends."""
    return F.btrim(line, F.lit(WHITE_SPACE))


def fields(line: Column, sep: str = ",") -> Column:
    """Fields of a stripped line; empty fields at its end do not count."""
    return F.split(F.rtrim(strip(line), F.lit(sep)), f"\\Q{sep}\\E")


def has_fields(line: Column, least: int, sep: str = ",") -> Column:
    """Whether ``fields`` would give at least that many, without making them."""
    inside, end = f"[^{re.escape(sep)}]", re.escape(sep)
    return strip(line).rlike(rf"\A(?:{inside}*+{end}){{{least - 1}}}{end}*+{inside}")


def is_ascii(text: Column) -> Column:
    return ~text.rlike(NON_ASCII)


def bucket(text: Column, buckets: int | Column) -> Column:
    """Spread text over 0 .. buckets-1 by the first 32 bits of its MD5."""
    count = F.lit(buckets) if isinstance(buckets, int) else buckets
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % count
