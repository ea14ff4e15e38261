"""Data quality: checks that ride along with the job instead of scanning the data again."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class EmptyInput(Exception):
    """The input holds no usable row."""


class CheckFailed(Exception):
    """A data check did not hold."""


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise `EmptyInput` if there is no row; stops at the first one found."""
    if df.isEmpty():
        raise EmptyInput(f"{what} has no rows")
    return df


def observe_counts(df: DataFrame, observation: Observation, **metrics: Column) -> DataFrame:
    """Count rows (and any other metric) while the data flows past.

    Values are there after an action on the result. A task that Spark runs twice after a lost
    executor may count twice, so use them for reports rather than for control."""
    columns = [F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]]
    return df.observe(observation, *columns)


def required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; the job that uses them fails at the first null in a required column."""
    types = dict(df.dtypes)
    checked = {
        c: F.coalesce(c, F.raise_error(F.lit(f"null in required column {c}")).cast(types[c]))
        for c in columns
    }
    return df.withColumns(checked)


def misses_required(columns: Sequence[str]) -> Column:
    """True where any of the columns is null."""
    return F.greatest(*[F.col(c).isNull() for c in columns], F.lit(False))


def split_required(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that fill all required columns, and the others."""
    missing = misses_required(columns)
    return df.filter(~missing), df.filter(missing)


def day_count(df: DataFrame, column: str, day: date | None = None) -> DataFrame:
    """Number of rows of one day (default: today). Works on a DATE or a timestamp column, with a
    range that prunes day partitions and Parquet row groups."""
    start = F.lit(day) if day is not None else F.current_date()
    in_day = (F.col(column) >= start) & (F.col(column) < F.date_add(start, 1))
    return df.filter(in_day).agg(F.count(F.lit(1)).alias("n"))


def check_truthy(df: DataFrame) -> None:
    """Raise `CheckFailed` unless the first row exists and all its values are truthy."""
    row = df.first()
    if row is None or not all(row):
        raise CheckFailed(f"check returned {row}")


def schema_report(df: DataFrame) -> str:
    return df.schema.treeString()
