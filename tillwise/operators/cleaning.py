"""Filters and null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column, or in any of the named columns."""
    return df.dropna(subset=list(columns) if columns else None)


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows that are null throughout, such as the blank tail of a spreadsheet export."""
    return df.dropna(how="all")


def fill_missing(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace nulls per column; other columns stay as they are."""
    return df.na.fill(values)


def equals(column: str, value: object) -> Column:
    """Equal to a constant; null does not match. Reaches the Parquet scan."""
    return F.col(column) == F.lit(value)


def differs(column: str, value: object) -> Column:
    """Not equal to a constant, where null counts as different (a plain `!=` drops nulls)."""
    return ~F.col(column).eqNullSafe(F.lit(value))


def above(column: str, bound: object) -> Column:
    return F.col(column) > F.lit(bound)


def usable_events(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Drop null records and records whose timestamp text is null or empty."""
    return df.filter(F.col(timestamp).isNotNull() & (F.col(timestamp) != ""))
