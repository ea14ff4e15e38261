"""Join forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.operators.joins import merge_join, skew_join
from tillwise.plans.employees import enrich
from tillwise.workload.registry import query, table


@query("""
SELECT c_name AS name, c_custkey, n.department, n.location
FROM (SELECT *, nullif(c_nationkey, 3) AS department FROM customer) c
JOIN (SELECT nullif(n_nationkey, 3) AS department, n_name AS location FROM nation) n
  ON c.department IS NOT DISTINCT FROM n.department
""")
def join_nullsafe(spark, sf_dir):
    """Missing keys group with missing keys, as in a grouping of both sides by key."""
    people = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.nullif("c_nationkey", F.lit(3)).alias("_dep")
    )
    places = table(spark, sf_dir, "nation").select(
        F.nullif("n_nationkey", F.lit(3)).alias("department"), F.col("n_name").alias("location")
    )
    return merge_join(
        people, places, ("_dep", "department"), ["name", "c_custkey", "department", "location"],
        null_safe=True, spread=["c_custkey"],
    )


@query("""
SELECT o_orderkey, o_custkey, c_name, o_totalprice, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def join_select(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
    )
    joined = skew_join(orders, customers, "o_custkey", spread=["o_orderkey"])
    return joined.select("o_orderkey", "o_custkey", "c_name", "o_totalprice", "c_mktsegment")


@query("""
SELECT p.user_id, count(*) AS pairs, count(DISTINCT p.event_id) AS purchases, max(v.value) AS most
FROM events p JOIN events v ON p.user_id = v.user_id AND v.event_type = 'view'
WHERE p.event_type = 'purchase' GROUP BY 1
""")
def join_many_to_many(spark, sf_dir):
    """All purchases of a user with all views: a user with many of both is hot on both sides."""
    events = table(spark, sf_dir, "events")
    bought = events.filter("event_type = 'purchase'").select("user_id", "event_id")
    seen = events.filter("event_type = 'view'").select("user_id", "value")
    return skew_join(bought, seen, "user_id").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct("event_id").alias("purchases"), F.max("value").alias("most")
    )


@query("""
SELECT a.o_orderkey, a.o_totalprice, b.o_orderpriority AS priority
FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey
""")
def join_self(spark, sf_dir):
    """A table joined to columns of itself; the right side is unique on the key."""
    orders = table(spark, sf_dir, "orders")
    right = orders.select("o_orderkey", "o_orderpriority").withColumnRenamed("o_orderpriority", "priority")
    return orders.join(right, "o_orderkey").select("o_orderkey", "o_totalprice", "priority")


@query("""
SELECT c_custkey AS "EmployeeID", c_mktsegment || '.' || c_name AS "FullName", c_name AS "Email",
       c_acctbal AS "Salary", c_mktsegment AS "JoinDate", n.dep AS "DepartmentID",
       n.n_name AS "DepartmentName", cast(round(c_acctbal) AS bigint) * cast(0.01 AS double) AS "EmpTax"
FROM (SELECT nullif(c_custkey, 7) AS c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment,
             c_acctbal, c_nationkey FROM customer) c
LEFT JOIN (SELECT CASE WHEN n_regionkey <> 1 THEN n_nationkey END AS dep, n_name FROM nation) n
  ON c.c_nationkey = n.dep
WHERE c_custkey IS NOT NULL
""")
def left_join_enrich(spark, sf_dir):
    """Customers as employees, nations as departments; one region's departments have lost their id."""
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    employees = table(spark, sf_dir, "customer").select(
        F.nullif("c_custkey", F.lit(7)).alias("EmployeeID"),
        segment.alias("FirstName"),
        F.col("c_name").alias("LastName"),
        F.col("c_name").alias("Email"),
        F.col("c_nationkey").alias("DepartmentID"),
        F.col("c_acctbal").alias("Salary"),
        segment.alias("JoinDate"),
    )
    departments = table(spark, sf_dir, "nation").select(
        F.when(F.col("n_regionkey") != 1, F.col("n_nationkey")).alias("DepartmentID"),
        F.col("n_name").alias("DepartmentName"),
    )
    return enrich(employees, departments)


@query("""
SELECT s_suppkey AS id, n_name AS name, n_nationkey AS nation
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def merge_select(spark, sf_dir):
    """Two records merged; on a name that both have, the right one wins."""
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name")
    )
    return merge_join(suppliers, nations, "nation", ["id", "name", "nation"], spread=["id"])
