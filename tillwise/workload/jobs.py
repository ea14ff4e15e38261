"""Whole jobs from files to tables, on files that Spark writes from the tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.plans import clickstream, customers, employees, retail
from tillwise.session import shared_dir
from tillwise.sources.files import read_parquet, read_table, read_text
from tillwise.workload.layouts import write_element_arrays, write_json_arrays
from tillwise.workload.registry import fresh_table, query, table


def _sales_text(spark, sf_dir):
    """Events as transactions: errors have an unreadable time, sign-ups no customer, large values no
    price."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("store_id"),
        F.col("event_type").alias("category_id"),
        F.get_json_object("props", "$.k").cast("int").alias("quantity"),
        F.when(F.col("value") <= 60, F.col("value")).alias("price"),
        F.when(F.col("event_type") == "error", "unknown").otherwise(stamp).alias("timestamp"),
        F.when(F.col("event_type") != "signup", F.col("user_id").cast("string")).alias("customer_id"),
    )


_SALES = """
SELECT cast(user_id AS varchar) AS store_id, event_type AS category_id,
       CASE WHEN event_type <> 'error' THEN cast(ts AS date) END AS transaction_date,
       cast(sum(cast(cast(json_extract_string(props, '$.k') AS integer) * value AS decimal(18,2))) AS double)
         AS total_sales
FROM events WHERE value <= 60 {more} GROUP BY 1, 2, 3
"""


@query(_SALES.format(more=""))
def daily_sales_from_text(spark, sf_dir):
    """Unreadable times stay as a group without a date."""
    return retail.daily_sales(_sales_text(spark, sf_dir), scale=2)


@query(_SALES.format(more="AND event_type <> 'signup'"))
def daily_sales_complete(spark, sf_dir):
    """The stricter cleaning, where a missing customer drops the row too."""
    return retail.daily_sales(_sales_text(spark, sf_dir), complete=None, scale=2)


@query(f"""
WITH sales AS ({_SALES.format(more="")})
SELECT *, CASE WHEN transaction_date IS NULL THEN 'quarantine' ELSE 'table' END AS target FROM sales
""")
def quarantined_sales(spark, sf_dir):
    """The partitioned table takes the dated rows, the quarantine folder the others."""
    name, place, aside = fresh_table(spark, "sales"), shared_dir(spark, "sales"), shared_dir(spark, "undated")
    retail.load_daily_table(retail.daily_sales(_sales_text(spark, sf_dir), scale=2), name, place, aside)
    columns = ["store_id", "category_id", "transaction_date", "total_sales"]
    loaded = read_table(spark, name).select(*columns, F.lit("table").alias("target"))
    undated = read_parquet(spark, aside).select(*columns, F.lit("quarantine").alias("target"))
    return loaded.unionByName(undated)


def _clicks(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_type",
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS event_date, json_extract_string(props, '$.k') AS product_id,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
       count(*) FILTER (WHERE event_type <> 'purchase') AS not_purchased_count
FROM events GROUP BY 1, 2
""")
def clickstream_from_files(spark, sf_dir):
    """Array files -> events -> both counts."""
    folder = shared_dir(spark, "click-arrays")
    write_json_arrays(_clicks(spark, sf_dir), folder)
    events, _ = clickstream.read_events(spark, folder, "array")
    return clickstream.both_counts(events)


@query("""
SELECT cast(ts AS date) AS event_date, json_extract_string(props, '$.k') AS product_id,
       count(*) AS purchase_count
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2
""")
def trends_append(spark, sf_dir):
    """Text lines -> strict parse -> purchases per day, appended with a DATE column."""
    folder, name = shared_dir(spark, "trend-lines"), fresh_table(spark, "trends")
    clicks = _clicks(spark, sf_dir)
    clicks.select(F.to_json(F.struct(*clicks.columns)).alias("value")).write.text(folder)
    clickstream.append_trends(read_text(spark, folder), name, shared_dir(spark, "trends"))
    return read_table(spark, name)


@query("""
SELECT cast(event_id AS varchar) AS customer_nbr, event_type AS customer_desc, cast(ts AS date) AS start_ts,
       cast(ts AS date) AS end_ts, cast(ts AS date) AS create_ts, cast(user_id AS varchar) AS create_user_id,
       cast(ts AS date) AS last_update_ts, cast(user_id AS varchar) AS last_update_user_id,
       date_trunc('second', ts) AS start_timestamp, date_trunc('second', ts) AS end_timestamp,
       date_trunc('second', ts) AS create_timestamp, date_trunc('second', ts) AS last_update_timestamp,
       props AS client_id
FROM events
""")
def customer_load(spark, sf_dir):
    """CSV with another header -> raw table by position -> typed table."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    user = F.col("user_id").cast("string")
    folder, place = shared_dir(spark, "customers-csv"), shared_dir(spark, "customers")
    table(spark, sf_dir, "events").select(
        F.col("event_id").alias("a"), F.col("event_type").alias("b"), stamp.alias("c"), stamp.alias("d"),
        stamp.alias("e"), user.alias("f"), stamp.alias("g"), user.alias("h"), F.col("props").alias("i"),
    ).write.option("header", True).option("escape", '"').csv(folder)
    raw, typed = fresh_table(spark, "customers_raw"), fresh_table(spark, "customers_typed")
    customers.load_customers(spark, folder, raw, typed, place)
    return read_table(spark, typed)


@query("""
SELECT c_custkey AS "EmployeeID", c_mktsegment || '.' || c_name AS "FullName", c_name AS "Email",
       c_acctbal AS "Salary", c_mktsegment AS "JoinDate", cast(n_nationkey AS bigint) AS "DepartmentID",
       n_name AS "DepartmentName", cast(round(c_acctbal) AS bigint) * cast(0.01 AS double) AS "EmpTax"
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def employee_load(spark, sf_dir):
    """Two typed CSVs without a header -> raw tables -> enriched table."""
    staff, departments = shared_dir(spark, "staff-csv"), shared_dir(spark, "departments-csv")
    table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_mktsegment AS first", "c_name AS last", "c_name AS mail", "c_nationkey", "c_acctbal",
        "c_mktsegment AS joined",
    ).write.csv(staff)
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.csv(departments)
    names = [fresh_table(spark, f"staff_{part}") for part in ("emp", "dep", "out")]
    employees.load_employees(spark, staff, departments, shared_dir(spark, "staff"), *names)
    return read_table(spark, names[2])


def _odd_clicks(spark, sf_dir):
    """Clicks as JSON texts: views bear a brace in a string, purchases a nested field, errors are null
    elements, sign-ups junk, and clicks of the first weeks have no timestamp."""
    clicks = _clicks(spark, sf_dir).withColumn("ts", F.to_timestamp_ntz("timestamp"))
    kind = F.col("event_type")
    fields = [
        "event_type", "product_id",
        F.when(kind == "view", F.concat(F.lit("u}{,"), "user_id")).otherwise(F.col("user_id")).alias("user_id"),
        F.when((kind == "click") & (F.dayofmonth("ts") <= 15), "").otherwise(F.col("timestamp")).alias("timestamp"),
        F.when(kind == "purchase", F.struct(F.lit("x").alias("os"), F.array(F.struct("product_id")).alias("seen"))).alias("device"),
    ]
    text = F.to_json(F.struct(*fields))
    return clicks.select(F.when(kind == "error", "null").when(kind == "signup", "17").otherwise(text).alias("value"))


_ODD = """
WITH c AS (SELECT *, event_type = 'click' AND day(ts) <= 15 AS undated FROM events WHERE event_type <> 'error')
SELECT 'purchases' AS target, strftime(ts, '%Y-%m-%d') AS event_date,
       json_extract_string(props, '$.k') AS product_id, count(*) AS n
FROM c WHERE event_type = 'purchase' GROUP BY ALL
UNION ALL
SELECT 'others', strftime(ts, '%Y-%m-%d'), json_extract_string(props, '$.k'), count(*)
FROM c WHERE event_type NOT IN ('purchase', 'signup') AND NOT undated GROUP BY ALL
UNION ALL
SELECT CASE WHEN undated THEN 'no timestamp' ELSE 'malformed json' END, NULL, NULL, count(*)
FROM c WHERE undated OR event_type = 'signup' GROUP BY ALL
"""


@query(_ODD)
def click_job_with_rejects(spark, sf_dir):
    """Odd array files -> two truncated tables, a folder of rejects and the counts of each."""
    source, rejects = shared_dir(spark, "odd-clicks"), shared_dir(spark, "click-rejects")
    write_element_arrays(_odd_clicks(spark, sf_dir), source)
    bought, other = fresh_table(spark, "odd_purchases"), fresh_table(spark, "odd_others")
    clickstream.load_counts(spark, source, bought, other, shared_dir(spark, "odd"), rejects)
    keys = ("event_date", "product_id")
    nothing = F.lit(None).cast("string")
    return (
        read_table(spark, bought).select(F.lit("purchases").alias("target"), *keys, F.col("purchase_count").alias("n"))
        .unionByName(read_table(spark, other).select(F.lit("others").alias("target"), *keys, F.col("not_purchased_count").alias("n")))
        .unionByName(
            read_parquet(spark, rejects).groupBy(F.col("reject_reason").alias("target")).agg(F.count(F.lit(1)).alias("n"))
            .select("target", nothing.alias("event_date"), nothing.alias("product_id"), "n")
        )
    )


def _sales_arrays(spark, sf_dir):
    """Transactions in array files; errors lose their time, sign-ups their store, large values their price."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_type")
    folder = shared_dir(spark, "sales-arrays")
    sales = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.when(kind != "signup", F.col("user_id").cast("string")).alias("store_id"),
        kind.alias("category_id"),
        F.get_json_object("props", "$.k").cast("int").alias("quantity"),
        F.when(F.col("value") <= 60, F.col("value")).alias("price"),
        F.when(kind == "error", "unknown").otherwise(stamp).alias("timestamp"),
        F.lit("c").alias("customer_id"),
    )
    write_json_arrays(sales, folder)
    return folder


_KEPT = "events WHERE event_type <> 'signup' AND value <= 60"


@query(f"""
SELECT cast(user_id AS varchar) AS store_id, event_type AS category_id,
       CASE WHEN event_type <> 'error' THEN cast(ts AS date) END AS transaction_date,
       round(sum(cast(json_extract_string(props, '$.k') AS integer) * value), 4) AS total_sales
FROM {_KEPT} GROUP BY 1, 2, 3
""")
def daily_sales_chain(spark, sf_dir):
    """Array files -> daily sums in a folder -> day-partitioned table and quarantine."""
    output, aside = shared_dir(spark, "sales-out"), shared_dir(spark, "sales-undated")
    name = fresh_table(spark, "sales_chain")
    retail.run_daily_sales(spark, _sales_arrays(spark, sf_dir), output, "flat_array")
    retail.load_daily_folder(spark, output, name, shared_dir(spark, "sales-table"), aside)
    columns = ["store_id", "category_id", "transaction_date", F.round("total_sales", 4).alias("total_sales")]
    return read_table(spark, name).select(*columns).unionByName(read_parquet(spark, aside).select(*columns))


@query(f"""
WITH kept AS (SELECT user_id, event_type, CASE WHEN event_type <> 'error' THEN cast(ts AS date) END AS d FROM {_KEPT})
SELECT 'read' AS stage, count(*) AS n FROM events UNION ALL SELECT 'corrupt', 0
UNION ALL SELECT 'kept', count(*) FROM kept UNION ALL SELECT 'undated', count(*) FROM kept WHERE d IS NULL
UNION ALL SELECT 'groups', count(*) FROM (SELECT DISTINCT * FROM kept)
UNION ALL SELECT 'empty input: ' || 'no data', 0
""")
def daily_sales_report(spark, sf_dir):
    """The counts that the same job reports, and its report on an input without a row."""
    report = retail.run_daily_sales(spark, _sales_arrays(spark, sf_dir), shared_dir(spark, "sales-counted"), "flat_array")
    empty = shared_dir(spark, "sales-none")
    table(spark, sf_dir, "events").filter("event_id < 0").select(F.lit("").alias("value")).write.text(empty)
    none = retail.run_daily_sales(spark, empty, shared_dir(spark, "sales-nothing"), "flat_array")
    rows = [(s, getattr(report, s)) for s in ("read", "corrupt", "kept", "undated", "groups")]
    return spark.createDataFrame([*rows, (f"empty input: {none.status}", none.read)], "stage string, n long")
