"""Nulls, means, distinct counts, duplicates, ranks and words.

The tables hold no nulls and no copies, so both sides make them: error events lose their type or
value, large values go missing, and tables are united with themselves.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.operators import aggregates, cleaning, dedup, ranking
from tillwise.workload.registry import query, table


def _gaps(spark, sf_dir):
    """Events whose type and value have different gaps."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") <= 60, F.col("value")).alias("value"),
    )


_GAPS = (
    "(SELECT event_id, nullif(event_type, 'error') AS event_type, "
    "CASE WHEN value <= 60 THEN value END AS value FROM events)"
)


@query(f"SELECT * FROM {_GAPS} WHERE event_type IS NOT NULL AND value IS NOT NULL")
def dropna_any(spark, sf_dir):
    return cleaning.drop_incomplete(_gaps(spark, sf_dir))


@query(f"SELECT * FROM {_GAPS} WHERE event_id IS NOT NULL AND value IS NOT NULL")
def dropna_subset(spark, sf_dir):
    return cleaning.drop_incomplete(_gaps(spark, sf_dir), ["event_id", "value"])


@query(f"""
SELECT event_id, coalesce(event_type, 'Unknown') AS event_type, coalesce(value, 0) AS value
FROM {_GAPS}
""")
def fill_nulls(spark, sf_dir):
    return cleaning.fill_missing(_gaps(spark, sf_dir), {"event_type": "Unknown", "value": 0.0})


@query(f"SELECT * FROM {_GAPS} WHERE value > 50")
def filter_gt(spark, sf_dir):
    return _gaps(spark, sf_dir).filter(cleaning.above("value", 50))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 5000")
def filter_gt_pushed(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return customers.filter(cleaning.above("c_acctbal", 5000))


def _silent_errors(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_type", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )


@query("""
SELECT event_type, round(avg(value), 6) AS mean_value FROM events
WHERE event_type <> 'error' GROUP BY event_type
""")
def avg_drop_null_groups(spark, sf_dir):
    means = aggregates.mean_of_present(_silent_errors(spark, sf_dir), "event_type", "value", "mean_value")
    return means.withColumn("mean_value", F.round("mean_value", 6))


@query("""
SELECT event_type, round(avg(CASE WHEN event_type <> 'error' THEN value END), 6) AS mean_value
FROM events GROUP BY event_type
""")
def avg_keep_null_groups(spark, sf_dir):
    means = aggregates.mean_by(_silent_errors(spark, sf_dir), "event_type", "value", "mean_value")
    return means.withColumn("mean_value", F.round("mean_value", 6))


@query("SELECT c_mktsegment, round(avg(c_acctbal), 2) AS mean_balance FROM customer GROUP BY 1")
def avg_rounded(spark, sf_dir):
    return aggregates.rounded_mean(
        table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal", "mean_balance"
    )


@query(f"SELECT count(DISTINCT value) AS n FROM {_GAPS}")
def count_distinct_nonnull(spark, sf_dir):
    return aggregates.distinct_present(_gaps(spark, sf_dir), "value")


@query(f"SELECT count(*) AS n FROM (SELECT DISTINCT value FROM {_GAPS})")
def count_distinct_with_null(spark, sf_dir):
    return aggregates.distinct_with_null(_gaps(spark, sf_dir), "value")


@query(f"SELECT DISTINCT event_type FROM {_GAPS}")
def distinct_values(spark, sf_dir):
    return dedup.distinct_values(_gaps(spark, sf_dir), "event_type")


@query("SELECT count(*) AS n FROM lineitem")
def global_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders)")
def dedup_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return dedup.distinct_rows(orders.unionByName(orders))


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1
""")
def dedup_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return dedup.first_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("""
SELECT word, count(*) AS count FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)
GROUP BY word
""")
def word_count(spark, sf_dir):
    return aggregates.word_counts(table(spark, sf_dir, "part"), "p_name")


@query("""
SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
GROUP BY word ORDER BY count DESC, word LIMIT 3
""")
def top3_words(spark, sf_dir):
    counts = aggregates.word_counts(table(spark, sf_dir, "documents"), "text")
    return ranking.top_k(counts, "count", ["word"], 3)


@query("""
SELECT string_agg(c_mktsegment || '=' || n, ',' ORDER BY n DESC, c_mktsegment) AS top FROM (
  SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_mktsegment IS NOT NULL
  GROUP BY 1 ORDER BY n DESC, c_mktsegment LIMIT 3)
""")
def top3_as_list(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isNotNull())
    counts = aggregates.count_by(customers, ["c_mktsegment"], "n")
    listed = ranking.top_k_list(counts, "n", ["c_mktsegment"], 3)
    text = F.transform("top", lambda e: F.concat_ws("=", e["c_mktsegment"], e["n"]))
    return listed.select(F.array_join(text, ",").alias("top"))


@query("""
SELECT max(value) AS second_highest FROM (
  SELECT value, dense_rank() OVER (ORDER BY value DESC) AS r FROM events) WHERE r = 2
""")
def second_highest_value(spark, sf_dir):
    return ranking.second_highest(table(spark, sf_dir, "events"), "value")


@query("""
SELECT event_id, user_id, value, 2 AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY value DESC, event_id) AS r FROM events) WHERE r = 2
""")
def second_highest_row(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return ranking.second_row(events, "value", ["event_id"])
