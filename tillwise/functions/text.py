"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(c: str | Column) -> Column:
    """Split on one space; consecutive spaces give empty words."""
    return F.split(c, " ")


def dash_to_null(c: str | Column) -> Column:
    """A lone `-` stands for a missing value."""
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("-"))


def dash_to_number(c: str | Column, dtype: str = "int") -> Column:
    return dash_to_null(c).try_cast(dtype)


def dotted_name(first: str | Column, last: str | Column) -> Column:
    """`first.last`, null if either part is null."""
    return F.concat(first, F.lit("."), last)
