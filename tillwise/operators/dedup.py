"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """One copy of each row; nulls equal each other. Copies collapse before the shuffle."""
    return df.dropDuplicates()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in `order` (which must be total to be repeatable).

    Spark limits each group to one row before the shuffle as well as after it, so a key that holds
    most of the rows sends one row per task.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
