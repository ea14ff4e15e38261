"""Grouped and global aggregates. All of them combine on the map side, so a hot group is cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.text import words


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_of_present(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Mean per key after dropping null values: a group of only nulls disappears."""
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg(F.avg(value).alias(name))


def mean_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Mean per key ignoring nulls: a group of only nulls stays, with a null mean."""
    return df.groupBy(key).agg(F.avg(value).alias(name))


def rounded_mean(df: DataFrame, key: str, value: str, name: str, places: int = 2) -> DataFrame:
    """`mean_of_present`, rounded half up on the decimal value."""
    return mean_of_present(df, key, value, name).withColumn(name, F.round(name, places))


def distinct_present(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Number of distinct values, nulls left out."""
    return df.agg(F.count_distinct(column).alias(name))


def distinct_with_null(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Number of distinct values, null counted as one of them."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias(name))


def word_counts(df: DataFrame, column: str) -> DataFrame:
    exploded = df.select(F.explode(words(column)).alias("word"))
    return count_by(exploded, ["word"])


def having(df: DataFrame, condition: Column) -> DataFrame:
    """Keep groups by an aggregated value."""
    return df.filter(condition)
