"""Catalog table sinks, written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.plans import clickstream, retail
from tillwise.session import shared_dir
from tillwise.sinks import versions
from tillwise.sinks.files import write_parquet
from tillwise.sinks.tables import append_table, load_partitioned, replace_table, truncate_table
from tillwise.sources.files import read_parquet, read_table
from tillwise.workload.registry import fresh_table, query, table

_SUPPLIER = "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"


@query("SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def table_append(spark, sf_dir):
    name, place = fresh_table(spark, "append"), shared_dir(spark, "append")
    for _ in range(2):
        append_table(table(spark, sf_dir, "supplier"), name, _SUPPLIER, place, ["s_suppkey"])
    return read_table(spark, name)


@query("SELECT * FROM supplier")
def table_truncate(spark, sf_dir):
    name, place = fresh_table(spark, "truncate"), shared_dir(spark, "truncate")
    for _ in range(2):
        truncate_table(table(spark, sf_dir, "supplier"), name, _SUPPLIER, place, ["s_suppkey"])
    return read_table(spark, name)


@query("""
SELECT 'after failure' AS version, s_suppkey, s_acctbal FROM supplier
UNION ALL SELECT 'after success', s_suppkey, s_acctbal FROM supplier WHERE s_acctbal >= 0
""")
def failed_overwrite(spark, sf_dir):
    """A folder is overwritten by a job that fails in its last row, then by one that does not."""
    folder, kept = shared_dir(spark, "overwritten"), shared_dir(spark, "overwritten-kept")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    write_parquet(rows, folder)
    last = rows.agg(F.max("s_suppkey")).first()[0]
    broken = F.when(F.col("s_suppkey") == last, F.raise_error(F.lit("the last row"))).otherwise(F.col("s_acctbal"))
    try:
        write_parquet(rows.withColumn("s_acctbal", broken.cast("double")), folder)
    except Exception as error:
        if "the last row" not in str(error):
            raise
    write_parquet(read_parquet(spark, folder), kept)
    write_parquet(rows.filter("s_acctbal >= 0"), folder)
    return (
        read_parquet(spark, kept).withColumn("version", F.lit("after failure"))
        .unionByName(read_parquet(spark, folder).withColumn("version", F.lit("after success")))
    )


@query("SELECT s_suppkey, s_acctbal * 2 AS doubled FROM supplier")
def table_replace(spark, sf_dir):
    """The second version is computed from the first, under the same name."""
    name, place = fresh_table(spark, "replace"), shared_dir(spark, "replace")
    replace_table(table(spark, sf_dir, "supplier"), name, place)
    doubled = read_table(spark, name).select("s_suppkey", (F.col("s_acctbal") * 2).alias("doubled"))
    replace_table(doubled, name, place)
    return read_table(spark, name)


@query("""
SELECT cast(user_id AS varchar) AS store_id, event_type AS category_id, cast(ts AS date) AS transaction_date,
       cast(sum(cast(value AS decimal(18,2))) AS double) AS total_sales
FROM events GROUP BY 1, 2, 3
""")
def partitioned_roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("store_id"),
        F.col("event_type").alias("category_id"),
        F.col("ts").cast("date").alias("transaction_date"),
        F.col("value").alias("total_price"),
    )
    name, place = fresh_table(spark, "daily"), shared_dir(spark, "daily")
    retail.load_daily_table(retail.sales_by(rows, scale=2), name, place)
    return read_table(spark, name).select("store_id", "category_id", "transaction_date", "total_sales")


@query("""
SELECT 'partitioned' AS version, event_id, event_type, cast(ts AS date) AS day FROM events
UNION ALL SELECT 'plain', event_id, event_type, cast(ts AS date) FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'again', event_id, event_type, cast(ts AS date) FROM events WHERE event_type <> 'purchase'
""")
def replace_partitioned(spark, sf_dir):
    """One name: partitioned, then plain, then partitioned again, with other rows each time."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("date").alias("day"))
    schema = ", ".join(f"{c} {t}" for c, t in events.dtypes)
    name, place = fresh_table(spark, "reparted"), shared_dir(spark, "reparted")
    versions = []

    def seen(version: str) -> None:
        kept = shared_dir(spark, f"reparted-{version}")
        read_table(spark, name).select(F.lit(version).alias("version"), *events.columns).write.parquet(kept)
        versions.append(spark.read.parquet(kept))

    load_partitioned(events, name, schema, place, "day", ["event_id"])
    seen("partitioned")
    replace_table(events.filter("event_type = 'purchase'"), name, place)
    seen("plain")
    load_partitioned(events.filter("event_type <> 'purchase'"), name, schema, place, "day", ["event_id"])
    seen("again")
    return versions[0].unionByName(versions[1]).unionByName(versions[2])


@query("""
SELECT 'days' AS version, event_type, cast(ts AS date) AS day, count(*) AS n FROM events GROUP BY 2, 3
UNION ALL SELECT 'types', event_type, NULL, count(*) FROM events GROUP BY 2
""")
def published_versions(spark, sf_dir):
    """A published name: partitioned by day, then without days, partitioned by type, computed from the first."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("date").alias("day"))
    name, place, kept = fresh_table(spark, "published"), shared_dir(spark, "published"), shared_dir(spark, "published-days")
    # a name of this run: a published name of another one would be a view, which fresh_table does not drop
    name += place.rsplit("-", 1)[-1]
    versions.publish(events, name, place, "day", ["event_id"])
    days = read_table(spark, name).groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("n"))
    write_parquet(days.select(F.lit("days").alias("version"), "event_type", "day", "n"), kept)
    versions.publish(read_table(spark, name).drop("day"), name, place, "event_type")
    types = read_table(spark, name).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    nothing = F.lit(None).cast("date").alias("day")
    return read_parquet(spark, kept).unionByName(types.select(F.lit("types").alias("version"), "event_type", nothing, "n"))


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS event_date, json_extract_string(props, '$.k') AS product_id,
       'purchase' AS kind, count(*) AS n
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2
UNION ALL
SELECT strftime(ts, '%Y-%m-%d'), json_extract_string(props, '$.k'), 'other', count(*)
FROM events WHERE event_type <> 'purchase' GROUP BY 1, 2
""")
def clickstream_tables(spark, sf_dir):
    """Both sinks filled from one pass."""
    events = table(spark, sf_dir, "events").select(
        "event_type",
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("ts").cast("date").alias("event_date"),
    )
    bought, other = fresh_table(spark, "purchases"), fresh_table(spark, "others")
    clickstream.write_counts(events, bought, other, shared_dir(spark, "clicks"))
    first = read_table(spark, bought).select(
        "event_date", "product_id", F.lit("purchase").alias("kind"), F.col("purchase_count").alias("n")
    )
    second = read_table(spark, other).select(
        "event_date", "product_id", F.lit("other").alias("kind"), F.col("not_purchased_count").alias("n")
    )
    return first.unionByName(second)
