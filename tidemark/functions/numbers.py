"""Reading and writing numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a number in a rating field.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def try_double(text: Column) -> Column:
    """The number in the text, NULL where there is none."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def two_decimals(number: Column) -> Column:
    """Two decimals, half-even on the exact binary value, no grouping, no lone leading zero."""
    plain = F.replace(F.format_number(number, 2), F.lit(","), F.lit(""))
    return F.regexp_replace(plain, r"^(-?)0\.", "$1.")
