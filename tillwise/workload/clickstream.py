"""Clickstream counts, parsing and the day check."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from tillwise.operators.quality import CheckFailed, EmptyInput, day_count, misses_required, require_rows
from tillwise.plans import clickstream
from tillwise.session import shared_dir
from tillwise.sources import clicks
from tillwise.sources.files import read_text
from tillwise.workload.registry import query, table


def _events(spark, sf_dir, event_type=None):
    """Events as clicks: the number in `props` is the product."""
    props = F.from_json("props", "k BIGINT")
    return table(spark, sf_dir, "events").select(
        F.col("event_type") if event_type is None else event_type.alias("event_type"),
        props["k"].cast("string").alias("product_id"),
        F.col("ts").cast("date").alias("event_date"),
    )


def _unknown_errors():
    return F.nullif("event_type", F.lit("error"))


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS event_date, json_extract_string(props, '$.k') AS product_id,
       count(*) AS purchase_count
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2
""")
def purchase_counts(spark, sf_dir):
    return clickstream.purchase_counts(_events(spark, sf_dir))


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS event_date, json_extract_string(props, '$.k') AS product_id,
       count(*) AS not_purchased_count
FROM events WHERE nullif(event_type, 'error') IS DISTINCT FROM 'purchase' GROUP BY 1, 2
""")
def not_purchased_counts(spark, sf_dir):
    return clickstream.not_purchased_counts(_events(spark, sf_dir, _unknown_errors()))


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS event_date, json_extract_string(props, '$.k') AS product_id,
       count(*) FILTER (WHERE nullif(event_type, 'error') IS NOT DISTINCT FROM 'purchase') AS purchase_count,
       count(*) FILTER (WHERE nullif(event_type, 'error') IS DISTINCT FROM 'purchase') AS not_purchased_count
FROM events GROUP BY 1, 2
""")
def clickstream_both(spark, sf_dir):
    return clickstream.both_counts(_events(spark, sf_dir, _unknown_errors()))


@query("SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events")
def json_to_table(spark, sf_dir):
    parsed = F.from_json("props", "k BIGINT")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


def _lines(spark, sf_dir, spoil: bool):
    """Events as JSON text lines. Spoiled: errors are cut short, sign-ups carry a fraction, clicks
    have an empty timestamp."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    if spoil:
        stamp = (
            F.when(F.col("event_type") == "signup", F.concat(stamp, F.lit(".5")))
            .when(F.col("event_type") == "click", F.lit(""))
            .otherwise(stamp)
        )
    record = F.to_json(
        F.struct(
            "event_type",
            F.get_json_object("props", "$.k").alias("product_id"),
            F.col("user_id").cast("string").alias("user_id"),
            stamp.alias("timestamp"),
        )
    )
    if spoil:
        cut = F.substring(record, 1, 20)
        record = F.when(F.col("event_type") == "error", cut).otherwise(record)
    return table(spark, sf_dir, "events").select("event_id", record.alias("value"))


@query("""
SELECT event_id,
       CASE WHEN event_type IN ('purchase', 'view') THEN cast(ts AS date) END AS event_date,
       CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS product_id,
       CASE event_type WHEN 'error' THEN 'malformed json' WHEN 'signup' THEN 'bad timestamp'
                       WHEN 'click' THEN 'no timestamp' END AS reject_reason
FROM events
""")
def corrupt_split(spark, sf_dir):
    parsed = clicks.parse_tolerant(_lines(spark, sf_dir, spoil=True))
    return parsed.select("event_id", "event_date", "product_id", "reject_reason")


@query("""
SELECT event_type, json_extract_string(props, '$.k') AS product_id,
       cast(user_id AS varchar) AS user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
       cast(ts AS date) AS event_date
FROM events
""")
def text_parse_strict(spark, sf_dir):
    folder = shared_dir(spark, "click-lines")
    _lines(spark, sf_dir, spoil=False).select("value").write.text(folder)
    return clicks.parse_strict(read_text(spark, folder))


@query("SELECT count(*) AS n FROM events WHERE cast(ts AS date) = DATE '2024-01-15'")
def dq_day_check(spark, sf_dir):
    return day_count(table(spark, sf_dir, "events"), "ts", date(2024, 1, 15))


@query("""
SELECT count(*) AS today, count(*) > 0 AS passed, FALSE AS passed_tomorrow, FALSE AS empty_passed
FROM events WHERE cast(ts AS date) = (SELECT max(cast(ts AS date)) FROM events)
""")
def dq_current_day(spark, sf_dir):
    """The check of today, of a day without rows, and of an empty input, on events moved so that the
    last day is today."""
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"))
    last = F.lit(events.agg(F.max("day")).first()[0])
    moved = events.select(F.date_add(F.current_date(), F.datediff("day", last)).alias("event_date"))
    today = day_count(moved, "event_date")

    def passes(check) -> bool:
        try:
            check()
        except (CheckFailed, EmptyInput):
            return False
        return True

    tomorrow = date.today() + timedelta(days=2)
    found = [
        passes(lambda: clickstream.check_day(moved)),
        passes(lambda: clickstream.check_day(moved, tomorrow)),
        passes(lambda: require_rows(events.filter("day < DATE '1000-01-01'"))),
    ]
    return today.select(F.col("n").alias("today"), *[F.lit(v).alias(n) for v, n in zip(found, ("passed", "passed_tomorrow", "empty_passed"))])


@query("""
SELECT count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS good,
       count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS rejected
FROM events
""")
def required_split(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "error", F.col("ts").cast("date")).alias("event_date"),
        F.nullif("event_type", F.lit("signup")).alias("event_type"),
    )
    missing = misses_required(["event_date", "event_type"])
    return events.agg(F.count_if(~missing).alias("good"), F.count_if(missing).alias("rejected"))


@query("""
WITH kept AS (SELECT * FROM events WHERE event_type <> 'error' AND value <= 60),
     grouped AS (SELECT event_type, CASE WHEN event_type <> 'view' THEN cast(ts AS date) END AS d
                 FROM kept GROUP BY 1, 2)
SELECT 'read' AS stage, count(*) AS n FROM events
UNION ALL SELECT 'kept', count(*) FROM kept
UNION ALL SELECT 'undated', count(*) FROM kept WHERE event_type = 'view'
UNION ALL SELECT 'groups', count(*) FROM grouped
""")
def stage_metrics(spark, sf_dir):
    """Row counts of every stage from one scan: group first, then add the groups up."""
    complete = F.col("event_type").isNotNull() & F.col("value").isNotNull()
    day = F.when(F.col("event_type") != "view", F.col("ts").cast("date"))
    events = table(spark, sf_dir, "events").select(
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") <= 60, F.col("value")).alias("value"),
        "ts",
    )
    groups = events.groupBy("event_type", day.alias("day")).agg(
        F.count(F.lit(1)).alias("read"), F.count_if(complete).alias("kept")
    )
    undated = F.when(F.col("day").isNull(), F.col("kept")).otherwise(F.lit(0))
    totals = groups.agg(
        F.sum("read").alias("read"),
        F.sum("kept").alias("kept"),
        F.sum(undated).alias("undated"),
        F.count_if(F.col("kept") > 0).alias("groups"),
    )
    return totals.unpivot([], ["read", "kept", "undated", "groups"], "stage", "n")
