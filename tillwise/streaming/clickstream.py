"""The daily clickstream append as an incremental job: each run takes the files that are new.

The checkpoint folder remembers which files were read. Every batch of new files adds its own counts and
its own rejected records, in folders named by the batch, so that a batch that runs again replaces
what it wrote before. Reading sums the batches: an event counts whenever its file arrives, late or
not, and days never have to be closed. Days are read from the text, so the session zone plays no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwise.plans.clickstream import KEYS, both_counts
from tillwise.sources import clicks


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """JSON Lines files of a folder as they arrive, one text per line."""
    return spark.readStream.text(folder)


def append_new_files(lines: DataFrame, counts: str, rejects: str, checkpoint: str) -> StreamingQuery:
    """Count everything that is new and stop; rejected records go to their own folder with a reason."""

    def add(batch: DataFrame, number: int) -> None:
        events = clicks.parse_tolerant(batch)
        both_counts(clicks.accepted(events)).write.mode("overwrite").parquet(f"{counts}/batch={number}")
        clicks.rejected(events).write.mode("overwrite").parquet(f"{rejects}/batch={number}")

    return (
        lines.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_counts(spark: SparkSession, counts: str) -> DataFrame:
    """Both counts per day and product over all batches."""
    return (
        spark.read.parquet(counts)
        .groupBy(*KEYS)
        .agg(F.sum("purchase_count").alias("purchase_count"), F.sum("not_purchased_count").alias("not_purchased_count"))
    )
