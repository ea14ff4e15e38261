"""Click event lines: a tolerant parser with a quarantine, and a strict one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.dates import click_day, click_day_strict
from tillwise.sources.files import CORRUPT, is_corrupt, once, parse_json_lines
from tillwise.sources.schemas import CLICK_EVENTS


def parse_tolerant(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse JSON lines and add `event_date` and `reject_reason` (null for a good record)."""
    return label_rejects(parse_json_lines(lines, CLICK_EVENTS, column))


def label_rejects(events: DataFrame) -> DataFrame:
    """Date the events; a record that is malformed or has no valid timestamp gets a reason."""
    dated = events.withColumn("event_date", once(click_day("timestamp")))
    reason = (
        F.when(is_corrupt(), F.lit("malformed json"))
        .when(F.coalesce("timestamp", F.lit("")) == "", F.lit("no timestamp"))
        .when(F.col("event_date").isNull(), F.lit("bad timestamp"))
    )
    return dated.withColumn("reject_reason", reason)


def accepted(events: DataFrame) -> DataFrame:
    return events.filter(F.col("reject_reason").isNull()).drop("reject_reason", CORRUPT)


def rejected(events: DataFrame) -> DataFrame:
    return events.filter(F.col("reject_reason").isNotNull())


def parse_strict(lines: DataFrame, column: str = "value") -> DataFrame:
    """Keep the four known fields and the date; any bad line or timestamp fails the job."""
    events = parse_json_lines(lines, CLICK_EVENTS, column)
    broken = F.raise_error(F.concat(F.lit("bad json line: "), F.col(CORRUPT))).cast("date")
    day = F.when(is_corrupt(), broken).otherwise(click_day_strict("timestamp"))
    return events.withColumn("event_date", day).drop(CORRUPT)
