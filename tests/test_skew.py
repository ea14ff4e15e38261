"""All queries on tables where one key, or one row with its copies, holds a third of the rows.

Broadcasts are off and the whole key column is sampled, so that joins take their skew path."""

import pytest

import __spark_entry__ as driver
from tillwise import workload
from compare import TABLES, connect, differences
from tillwise.operators import joins

SF = "/root/testdata/sf0.001"
# The text operators have tests of their own.
QUERIES = workload.queries()

# One in three rows gets the hot key; events and documents also hold copies of one row.
SKEWED = {
    "lineitem": """SELECT * REPLACE (
        CASE WHEN r % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey,
        CASE WHEN r % 3 = 1 THEN 5 ELSE l_suppkey END AS l_suppkey,
        CASE WHEN r % 3 = 2 THEN 3 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN r % 3 = 0 THEN TIMESTAMP '1998-01-01' ELSE l_shipdate END AS l_shipdate) FROM t""",
    "orders": "SELECT * REPLACE (CASE WHEN r % 3 = 0 THEN 2 ELSE o_custkey END AS o_custkey) FROM t",
    "customer": "SELECT * REPLACE (CASE WHEN r % 3 = 0 THEN 3 ELSE c_nationkey END AS c_nationkey) FROM t",
    "supplier": "SELECT * REPLACE (CASE WHEN r % 3 = 0 THEN 4 ELSE s_nationkey END AS s_nationkey) FROM t",
    "events": "SELECT * FROM t UNION ALL (SELECT t.* FROM t, t AS u WHERE t.r = 5 AND u.r % 2 = 0)",
    "documents": "SELECT * FROM t UNION ALL (SELECT t.* FROM t, t AS u WHERE t.r = 5 AND u.r % 2 = 0)",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = connect(SF)
    for name in TABLES:
        sql = SKEWED.get(name, "SELECT * FROM t")
        numbered = f"WITH t AS (SELECT *, row_number() OVER () AS r FROM {name})"
        con.execute(f"COPY ({numbered} SELECT * EXCLUDE (r) FROM ({sql})) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder, connect(folder)


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins.find_hot_keys, "__defaults__", (1.0,))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql_on_skewed_tables(spark, skewed, no_broadcast, name):
    folder, con = skewed
    assert differences(QUERIES[name](spark, folder), con, driver.oracle_sql()[name]) == []


@pytest.mark.parametrize(
    "name", ["sales_display", "retail_sales_by_brand", "retail_sales_by_region", "join_select", "join_nullsafe", "left_join_enrich"]
)
def test_row_level_joins_split_the_hot_key(spark, skewed, no_broadcast, name):
    plan = QUERIES[name](spark, skewed[0])._jdf.queryExecution().executedPlan().toString()
    assert "_salt_left" in plan and "_salt_right" in plan
