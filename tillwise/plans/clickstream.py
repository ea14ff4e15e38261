"""Clickstream: events -> day -> purchase and other counts per day and product."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.dates import click_day
from tillwise.operators.aggregates import count_by
from tillwise.operators.cleaning import differs, equals, usable_events
from tillwise.operators.quality import check_truthy, day_count
from tillwise.session import shared_dir
from tillwise.sinks.files import check_output, write_parquet
from tillwise.sinks.tables import append_table, truncate_table
from tillwise.sources import clicks
from tillwise.sources.files import CORRUPT, read_json_array, read_text
from tillwise.sources.schemas import (
    ABANDONED,
    ABANDONED_REQUIRED,
    CLICK_EVENTS,
    NOT_PURCHASED,
    NOT_PURCHASED_REQUIRED,
    PURCHASES,
    PURCHASES_REQUIRED,
    TRENDS,
)

# Fixed value: the event type that counts as a sale.
PURCHASE = "purchase"
KEYS = ("event_date", "product_id")


def read_events(spark: SparkSession, path: str, layout: str = "array") -> tuple[DataFrame, DataFrame]:
    """Dated events, and the rejected records with their reason. A bad record is skipped by itself;
    the rest of its file is kept. `array`: array files of any objects, large ones split; `multi_line`:
    the same, one task per file; `lines`: one object per line."""
    if layout in ("array", "multi_line"):
        events = clicks.label_rejects(read_json_array(spark, path, CLICK_EVENTS, split=layout == "array"))
    elif layout == "lines":
        events = clicks.parse_tolerant(read_text(spark, path))
    else:
        raise ValueError(f"unknown layout: {layout}")
    return clicks.accepted(events), clicks.rejected(events)


def load_counts(
    spark: SparkSession,
    source: str,
    purchases: str,
    others: str,
    location: str,
    rejects: str,
    layout: str = "array",
) -> dict[str, int]:
    """The whole job: read, write the rejected records to a folder, truncate and load both tables.

    Returns the number of accepted records and of rejected ones by reason."""
    events, bad = read_events(spark, source, layout)
    check_output(rejects, [source])
    stage = shared_dir(spark, "click-records")
    both = events.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)
    both.write.partitionBy("reject_reason").parquet(stage)
    records = spark.read.parquet(stage)
    write_parquet(records.filter("reject_reason is not null"), rejects, inputs=[source])
    good = records.filter("reject_reason is null").drop("reject_reason", CORRUPT)
    write_counts(good, purchases, others, location)
    return {r.reason: r.n for r in records.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("n")).collect()}


def with_event_date(events: DataFrame) -> DataFrame:
    """Drop events without a timestamp and add their date; the date stays a DATE so that grouping
    works on a number, `as_text` writes it out afterwards."""
    return usable_events(events).withColumn("event_date", click_day("timestamp"))


def as_text(counts: DataFrame) -> DataFrame:
    return counts.withColumn("event_date", F.col("event_date").cast("string"))


def purchase_counts(events: DataFrame) -> DataFrame:
    return as_text(count_by(events.filter(equals("event_type", PURCHASE)), KEYS, "purchase_count"))


def not_purchased_counts(events: DataFrame, name: str = "not_purchased_count") -> DataFrame:
    """Events of any other type; an event without a type is one of them."""
    return as_text(count_by(events.filter(differs("event_type", PURCHASE)), KEYS, name))


def both_counts(events: DataFrame) -> DataFrame:
    """Both counts in one scan and one shuffle."""
    return as_text(
        events.groupBy(*KEYS).agg(
            F.count_if(equals("event_type", PURCHASE)).alias("purchase_count"),
            F.count_if(differs("event_type", PURCHASE)).alias("not_purchased_count"),
        )
    )


def split_counts(counts: DataFrame, name: str = "not_purchased_count") -> tuple[DataFrame, DataFrame]:
    """The two outputs out of `both_counts`."""
    bought = counts.filter(F.col("purchase_count") > 0).select(*KEYS, "purchase_count")
    other = counts.filter(F.col("not_purchased_count") > 0).select(
        *KEYS, F.col("not_purchased_count").alias(name)
    )
    return bought, other


def write_counts(
    events: DataFrame,
    purchases: str,
    others: str,
    location: str,
    *,
    append: bool = False,
    abandoned: bool = False,
) -> None:
    """Write both tables from one pass over the events.

    The combined counts go to a shared folder once, and both tables are filled from there: nothing is
    counted twice, and a lost executor does not take cached blocks with it."""
    spark = events.sparkSession
    stage = shared_dir(spark, "click-counts")
    both_counts(events).write.parquet(stage)
    name, schema, need = (
        ("abandoned_count", ABANDONED, ABANDONED_REQUIRED)
        if abandoned
        else ("not_purchased_count", NOT_PURCHASED, NOT_PURCHASED_REQUIRED)
    )
    bought, other = split_counts(spark.read.parquet(stage), name)
    write = append_table if append else truncate_table
    write(bought, purchases, PURCHASES, f"{location}/purchases", PURCHASES_REQUIRED)
    write(other, others, schema, f"{location}/others", need)


def append_trends(lines: DataFrame, table: str, location: str) -> None:
    """Strict variant: parse lines, count purchases per day, append with a DATE column."""
    append_table(strict_purchase_counts(clicks.parse_strict(lines)), table, TRENDS, location)


def strict_purchase_counts(events: DataFrame) -> DataFrame:
    """Purchases per day as a DATE. The filter looks at the date of every event, so that a bad
    timestamp fails the job on any event type and not only on purchases."""
    bought = F.when(F.col("event_date").isNotNull(), equals("event_type", PURCHASE))
    return count_by(events.filter(bought), KEYS, "purchase_count")


def check_day(trends: DataFrame, day: date | None = None) -> None:
    """Fail unless the table has rows for the day (default: today)."""
    check_truthy(day_count(trends, "event_date", day))
