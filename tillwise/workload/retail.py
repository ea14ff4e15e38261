"""Retail sums and sales reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.functions.numbers import minor_units
from tillwise.operators.joins import skew_join
from tillwise.plans import reports, retail
from tillwise.workload.registry import query, table


# Tells line items apart; only read where a hot key has to be split.
_LINE_ID = ("l_orderkey", "l_linenumber")


def _transactions(spark, sf_dir):
    """Line items as transactions: supplier = store, return flag = category."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_returnflag").alias("category_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("timestamp"),
    )


@query("""
SELECT l_suppkey AS store_id, l_returnflag AS category_id, cast(l_shipdate AS date) AS transaction_date,
       cast(sum(cast(l_quantity * l_extendedprice AS decimal(18,2))) AS double) AS total_sales
FROM lineitem GROUP BY 1, 2, 3
""")
def retail_sales_daily(spark, sf_dir):
    rows = _transactions(spark, sf_dir).withColumns(
        {
            "total_price": F.col("quantity") * F.col("price"),
            "transaction_date": F.col("timestamp").cast("date"),
        }
    )
    return retail.sales_by(rows, scale=2)


@query("""
SELECT l_suppkey AS store_id, p_brand AS category_id, cast(l_shipdate AS date) AS transaction_date,
       cast(sum(cast(l_quantity * p_retailprice AS decimal(18,2))) AS double) AS total_sales
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
""")
def retail_sales_by_brand(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", *_LINE_ID
    )
    joined = skew_join(lines, part, ("l_partkey", "p_partkey"), spread=[*_LINE_ID, "l_suppkey"])
    rows = joined.select(
        F.col("l_suppkey").alias("store_id"),
        F.col("p_brand").alias("category_id"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("total_price"),
    )
    return retail.sales_by(rows, scale=2)


@query("""
SELECT s_nationkey AS store_id, p_brand AS category_id,
       cast(sum(cast(l_quantity * p_retailprice AS decimal(18,2))) AS double) AS total_sales
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY 1, 2
""")
def retail_sales_by_region(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", *_LINE_ID)
    joined = skew_join(lines, part, ("l_partkey", "p_partkey"), spread=[*_LINE_ID, "l_suppkey"])
    # Per supplier and brand first: the supplier join then sees a bounded number of rows per key.
    per_supplier = joined.groupBy("l_suppkey", "p_brand").agg(
        F.sum(minor_units(F.col("l_quantity") * F.col("p_retailprice"))).alias("cents")
    )
    return (
        per_supplier.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("store_id"), F.col("p_brand").alias("category_id"))
        .agg((F.sum("cents").cast("double") / F.lit(100.0)).alias("total_sales"))
    )


@query("""
SELECT event_type AS category_id, cast(ts AS date) AS transaction_date,
       cast(sum(cast(value AS decimal(18,2))) AS double) AS total_sales
FROM (SELECT nullif(event_type, 'error') AS event_type, ts,
             CASE WHEN event_type <> 'signup' THEN value END AS value FROM events)
WHERE event_type IS NOT NULL AND value IS NOT NULL
GROUP BY 1, 2
""")
def amount_sales_daily(spark, sf_dir):
    """Transactions with an amount, through the whole job: complete rows, ISO text to date, sum."""
    rows = table(spark, sf_dir, "events").select(
        F.lit("all").alias("store_id"),
        F.nullif("event_type", F.lit("error")).alias("category_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("amount"),
    )
    return retail.amount_sales(rows, scale=2).drop("store_id")


def _sales(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sales_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
    )


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
    )


def _products(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("description"),
        F.col("p_brand").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


@query("""
SELECT l_orderkey || '-' || l_linenumber AS sales_id, cast(o_orderdate AS date) AS order_date,
       c_name AS customer_name, p_name AS product_name, p_type AS description, p_brand AS category,
       l_quantity AS quantity, p_retailprice AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey
""")
def sales_display(spark, sf_dir):
    return reports.sales_display(
        _sales(spark, sf_dir), _orders(spark, sf_dir), _customers(spark, sf_dir),
        _products(spark, sf_dir), spread=["sales_id", "product_id", "quantity"],
    )


@query("""
SELECT l_partkey AS product_id, p_name AS name,
       cast(sum(cast(l_quantity * p_retailprice AS decimal(18,2))) AS double) AS total_sales
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
ORDER BY total_sales DESC, product_id LIMIT 5
""")
def top5_products(spark, sf_dir):
    return reports.top_products(_sales(spark, sf_dir), _products(spark, sf_dir), scale=2)


@query("""
SELECT l_partkey AS product_id, p_name AS name,
       cast(sum(l_quantity) AS double) * (p_retailprice / 8) AS total_sales
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, p_retailprice
ORDER BY total_sales DESC, product_id LIMIT 5
""")
def top5_products_fine_price(spark, sf_dir):
    """Prices with up to five decimals: nothing is rounded before the product."""
    products = _products(spark, sf_dir).withColumn("price", F.col("price") / 8)
    return reports.top_products(_sales(spark, sf_dir), products)


@query("""
SELECT o_custkey AS customer_id, c_name AS customer_name, count(*) AS total_orders
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
ORDER BY total_orders DESC, customer_id LIMIT 5
""")
def top5_customers_by_orders(spark, sf_dir):
    return reports.top_customers_by_orders(_orders(spark, sf_dir), _customers(spark, sf_dir))


@query("""
SELECT o_custkey AS customer_id, c_name AS customer_name,
       cast(sum(cast(l_quantity * l_extendedprice AS decimal(18,2))) AS double) AS total_sales,
       sum(l_quantity) AS total_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2 HAVING sum(l_quantity) >= 1500
ORDER BY total_sales DESC, customer_id LIMIT 2
""")
def top2_having(spark, sf_dir):
    sales = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    return reports.top_customers_by_sales(
        sales, _orders(spark, sf_dir), _customers(spark, sf_dir), min_quantity=1500, scale=2
    )
