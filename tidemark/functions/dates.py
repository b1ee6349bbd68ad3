"""Reading and writing dates as text."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MONTH_YEAR = "dd.MM.yy"
#: The last day that a two-digit year can mean.
LATEST = date(2068, 12, 31)


def parse_date(
    text: Column, fmt: str = DAY_MONTH_YEAR, latest: date = LATEST
) -> Column:
    """The date in the text, NULL where it does not fit the format.

    A two-digit year means the one in the hundred years that end with ``latest``.
    """
    found = F.try_to_timestamp(text, F.lit(fmt)).cast("date")
    if "yy" in fmt and "yyy" not in fmt:
        # the reader puts two digits into 2000 to 2099
        found = F.when(found > F.lit(latest), F.add_months(found, -1200)).otherwise(found)
    return found


def format_date(date: Column, fmt: str = DAY_MONTH_YEAR) -> Column:
    return F.date_format(date, fmt)
