"""Top-k and second-highest. Each needs a total order, so ties always fall the same way."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, ties: Sequence[str], k: int) -> DataFrame:
    """The k rows with the highest `by`; every task keeps k rows, so nothing is fully sorted."""
    return df.orderBy(F.desc(by), *ties).limit(k)


def top_k_list(df: DataFrame, by: str, ties: Sequence[str], k: int, name: str = "top") -> DataFrame:
    """The same as one row holding an ordered array of at most k structs."""
    entries = F.collect_list(F.struct((-F.col(by)).alias("_order"), *[F.col(t) for t in ties], F.col(by)))
    return top_k(df.select(*ties, by), by, ties, k).agg(
        F.transform(
            F.sort_array(entries), lambda e: F.struct(*[e[c].alias(c) for c in (*ties, by)])
        ).alias(name)
    )


def second_row(df: DataFrame, by: str, ties: Sequence[str]) -> DataFrame:
    """Row number 2 of the descending order, as a whole row; ties take two numbers.

    The limit keeps the one-task window down to two rows (Spark puts the same limit below a global
    `row_number() = 2`, here it does not depend on that rule).
    """
    ranked = top_k(df, by, ties, 2)
    order = W.orderBy(F.desc(by), *ties)
    return ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == 2)


def second_highest(df: DataFrame, column: str, name: str = "second_highest") -> DataFrame:
    """The second highest distinct non-null value in one row; null if there are fewer than two."""
    two = (
        df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(F.desc(column)).limit(2)
    )
    return two.agg(F.when(F.count(F.lit(1)) == 2, F.min(column)).alias(name))
