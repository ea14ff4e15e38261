"""Shape of the physical plans."""

import pytest

import __spark_entry__ as driver
from tillwise import workload
from pyspark.sql import functions as F
from tillwise.operators import dedup, ranking

SF = "/root/testdata/sf0.001"
# The text operators have tests of their own.
QUERIES = workload.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize(
    "name, parts",
    [
        ("purchase_counts", ["EqualTo(event_type,purchase)"]),
        ("filter_gt_pushed", ["GreaterThan(c_acctbal,5000.0)"]),
        ("dq_day_check", ["GreaterThanOrEqual(ts,2024-01-15", "LessThan(ts,2024-01-16"]),
        ("top3_words", ["TakeOrderedAndProject(limit=3"]),
        ("second_highest_row", ["TakeOrderedAndProject(limit=2"]),
        ("top5_products", ["TakeOrderedAndProject(limit=5"]),
        ("dedup_by_key", ["WindowGroupLimit"]),
        ("count_distinct_nonnull", ["ReadSchema: struct<value:double>"]),
        ("global_count", ["ReadSchema: struct<>"]),
        ("word_count", ["ReadSchema: struct<p_name:string>"]),
    ],
)
def test_plan_contains(spark, name, parts):
    text = plan(QUERIES[name](spark, SF))
    for part in parts:
        assert part in text


@pytest.mark.parametrize("name, shuffles", [("clickstream_both", 1), ("retail_sales_daily", 1), ("flatten_sessions", 0), ("customer_typed", 0), ("stage_metrics", 2)])
def test_number_of_shuffles(spark, name, shuffles):
    assert plan(QUERIES[name](spark, SF)).count("Exchange ") == shuffles


def test_group_limit_runs_before_and_after_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey", "o_orderkey")
    text = plan(dedup.first_per_key(df, ["o_custkey"], ["o_orderkey"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_second_value_is_bounded(spark):
    df = spark.range(100).select(F.col("id").alias("v"))
    assert "TakeOrderedAndProject(limit=2" in plan(ranking.second_highest(df, "v"))
