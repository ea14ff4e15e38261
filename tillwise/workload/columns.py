"""Typing, renaming and text repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.functions.dates import mixed_datetime, short_year_date
from tillwise.functions.text import dash_to_null, dash_to_number
from tillwise.operators.nested import flatten_sessions as flatten
from tillwise.plans.customers import typed_customers
from tillwise.workload.registry import query, table


@query("""
SELECT cast(event_id AS varchar) AS customer_nbr, event_type AS customer_desc,
       cast(s AS date) AS start_ts, cast(s AS date) AS end_ts, cast(s AS date) AS create_ts,
       cast(user_id AS varchar) AS create_user_id, cast(e AS date) AS last_update_ts,
       cast(user_id AS varchar) AS last_update_user_id, s AS start_timestamp, s AS end_timestamp,
       s AS create_timestamp, e AS last_update_timestamp, props AS client_id
FROM (SELECT *, date_trunc('second', ts) AS s,
             CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS e FROM events)
""")
def customer_typed(spark, sf_dir):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("customer_nbr"),
        F.col("event_type").alias("customer_desc"),
        stamp.alias("start_ts"),
        stamp.alias("end_ts"),
        stamp.alias("create_ts"),
        F.col("user_id").cast("string").alias("create_user_id"),
        F.when(F.col("event_type") != "error", stamp).alias("last_update_ts"),
        F.col("user_id").cast("string").alias("last_update_user_id"),
        F.col("props").alias("client_id"),
    )
    return typed_customers(raw)


@query("SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal AS balance FROM supplier")
def rename_select(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "supplier_id")
    return suppliers.select(
        "supplier_id", F.col("s_name").alias("supplier_name"), F.col("s_acctbal").alias("balance")
    )


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS segment,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_nationkey END AS runs
FROM customer
""")
def dash_as_null(spark, sf_dir):
    dashed = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "MACHINERY", "-").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "-")
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("runs"),
    )
    return dashed.select(
        "c_custkey", dash_to_null("segment").alias("segment"), dash_to_number("runs").alias("runs")
    )


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('minute', ts) END AS at,
       CASE WHEN event_type <> 'error' THEN cast(ts AS date) - INTERVAL 30 YEAR END AS day
FROM events
""")
def mixed_dates(spark, sf_dir):
    """Three layouts in one column, unreadable text for errors, and two-digit years."""
    text = (
        F.when(F.col("event_type") == "error", "unknown")
        .when(F.col("event_type") == "view", F.date_format("ts", "dd-MM-yyyy HH:mm"))
        .when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:'00'"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:'00'"))
    )
    short = F.date_format(F.add_months("ts", -360), "d-MMM-yy")
    texts = table(spark, sf_dir, "events").select(
        "event_id",
        text.alias("at"),
        F.when(F.col("event_type") == "error", "-").otherwise(short).alias("day"),
    )
    return texts.select(
        "event_id", mixed_datetime("at").alias("at"), short_year_date("day").cast("timestamp_ntz").alias("day")
    )


def _users(spark, sf_dir):
    """Messages as users: lines are sessions, words are page views, first turns have no session."""
    lines = F.filter(F.split("text", "\n"), lambda line: F.trim(line) != "")
    views = lambda line: F.transform(
        F.filter(F.split(line, " "), lambda w: w != ""),
        lambda w: F.struct(w.alias("page"), F.length(w).cast("bigint").alias("duration")),
    )
    sessions = F.transform(
        lines,
        lambda line, i: F.struct(
            (i + 1).cast("string").alias("session_id"),
            F.col("role").alias("start_time"),
            F.when(F.length(line) > 40, views(line)).otherwise(F.filter(views(line), lambda _: F.lit(False))).alias("page_views"),
        ),
    )
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("user_id"),
        F.col("role").alias("name"),
        F.struct(F.col("role").alias("city"), F.col("turn").cast("string").alias("country")).alias("location"),
        F.when(F.col("turn") > 0, sessions).otherwise(F.filter(sessions, lambda _: F.lit(False))).alias("sessions"),
    )


_VIEWS = """
WITH users AS (
  SELECT conv_id || '-' || turn AS user_id, role AS name, role AS city, cast(turn AS varchar) AS country,
         CASE WHEN turn > 0 THEN [x FOR x IN string_split(text, chr(10)) IF trim(x, ' ') <> ''] ELSE [] END AS lines
  FROM conversations),
sessions AS (
  SELECT user_id, name, city, country, cast(i AS varchar) AS session_id, name AS start_time, lines[i] AS line
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM users)),
views AS (
  SELECT user_id, name, city, country, session_id, start_time, page, length(page) AS duration
  FROM (SELECT *, unnest([x FOR x IN string_split(line, ' ') IF x <> '']) AS page
        FROM sessions WHERE length(line) > 40))
SELECT * FROM views
"""


@query(_VIEWS)
def flatten_sessions_inner(spark, sf_dir):
    return flatten(_users(spark, sf_dir), keep_empty=False)


@query(_VIEWS + """
UNION ALL
SELECT user_id, name, city, country, session_id, start_time, NULL, NULL FROM sessions WHERE length(line) <= 40
UNION ALL
SELECT user_id, name, city, country, NULL, NULL, NULL, NULL FROM users WHERE len(lines) = 0
""")
def flatten_sessions(spark, sf_dir):
    return flatten(_users(spark, sf_dir))
