"""Numbering rows in order inside groups without a window over a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOCAL_BITS = 33  # fixed value: `monotonically_increasing_id` has the row's number in these


def number(df: DataFrame, group: str, order: list, folder: str) -> DataFrame:
    """`df` with `place`, from 0 in each group by `order`, and `members`, the group's number of rows.

    Rows are range-sorted by (group, order) into a table at `folder`, so a group of any size is spread over
    many tasks; a row's place is its place in its task plus the rows of its group in earlier tasks. The only
    window is over the tasks of a group. `group` must not be null. Rows that tie in everything get
    different places in either order.
    """
    keys = [F.col(group), *order]
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.withColumn("spot", F.monotonically_increasing_id()).write.parquet(folder)
    rows = df.sparkSession.read.parquet(folder).withColumn("task", F.shiftright("spot", LOCAL_BITS))
    heads = rows.groupBy(group, "task").agg(F.min("spot").alias("first_spot"), F.count("*").alias("n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(
        F.col(group).alias("head_group"),
        F.col("task").alias("head_task"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_spot")).alias("shift"),
        F.sum("n").over(whole).alias("members"),
    )
    joined = rows.join(heads, (F.col(group) == F.col("head_group")) & (F.col("task") == F.col("head_task")))
    return joined.select(*df.columns, (F.col("spot") + F.col("shift")).alias("place"), "members")
