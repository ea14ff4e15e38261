"""Date and timestamp parsing.

Texts are checked against a layout and then cast, because Spark's own string cast is faster than a
pattern formatter and does not go through the session time zone. `try_*` forms give null for bad
text; strict forms fail the job whatever the ANSI setting is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layouts of the timestamp texts (fields may have one digit, no fraction). `\z` is the
# very end, where `$` would let a trailing line break pass.
CLICK_LAYOUT = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\z"
WAREHOUSE_LAYOUT = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\z"
DAY_FIRST_LAYOUT = r"^(\d{1,2})-(\d{1,2})-(\d{4}) (\d{1,2}:\d{1,2}(?::\d{1,2})?)\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_fail(value: Column, dtype: str, message: Column) -> Column:
    """`value`, or a failed job where it is null."""
    return F.coalesce(value, F.raise_error(message).cast(dtype))


def iso_date(c: str | Column) -> Column:
    """Date of an ISO text, fraction and zone allowed; null if it cannot be read."""
    return _col(c).try_cast("date")


def try_datetime(c: str | Column, layout: str) -> Column:
    c = _col(c)
    return F.when(c.rlike(layout), c.try_cast("timestamp_ntz"))


def click_day(c: str | Column) -> Column:
    """Date of a `yyyy-MM-ddTHH:mm:ss` text; null if it does not match exactly."""
    return try_datetime(c, CLICK_LAYOUT).cast("date")


def click_date(c: str | Column) -> Column:
    """As `click_day`, written as `yyyy-MM-dd` text."""
    return click_day(c).cast("string")


def click_day_strict(c: str | Column) -> Column:
    """As `click_day`, but a null or malformed timestamp fails the job."""
    text = F.coalesce(_col(c), F.lit("null"))
    return or_fail(click_day(c), "date", F.concat(F.lit("bad event timestamp: "), text))


def warehouse_datetime(c: str | Column) -> Column:
    """Zone-less datetime of a `yyyy-MM-dd HH:mm:ss` text. Null stays null, a mismatch fails."""
    c = _col(c)
    parsed = try_datetime(c, WAREHOUSE_LAYOUT)
    checked = or_fail(parsed, "timestamp_ntz", F.concat(F.lit("bad datetime: "), c))
    return F.when(c.isNotNull(), checked)


def mixed_datetime(c: str | Column) -> Column:
    """Datetime of a column that mixes ISO texts with `dd-MM-yyyy HH:mm`; null if neither fits."""
    return F.regexp_replace(_col(c), DAY_FIRST_LAYOUT, "$3-$2-$1 $4").try_cast("timestamp_ntz")


def short_year_date(c: str | Column) -> Column:
    """Date of a `d-MMM-yy` text with two-digit years 69-99 in the 1900s; null if unreadable."""
    c = _col(c)
    year = F.right(c, F.lit(2))
    century = F.when(year >= "69", "19").otherwise("20")
    return F.try_to_date(F.concat(F.left(c, F.length(c) - 2), century, year), "d-MMM-yyyy")
