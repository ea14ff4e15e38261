import pytest
from pyspark.sql import functions as F

from tillwise.operators import joins
from tillwise.operators.joins import find_hot_keys, merge_join, skew_join


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def facts(spark, n=6000):
    """A third of the rows under key 1, a sixth under null."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(1))
        .when(F.col("id") % 6 == 1, F.lit(None))
        .otherwise(F.col("id") % 50)
        .cast("bigint")
    )
    return spark.range(n).select(F.col("id").alias("row"), key.alias("k"))


def dims(spark):
    with_null = spark.range(40).select(F.col("id").alias("d"), F.concat(F.lit("n"), "id").alias("name"))
    return with_null.union(spark.createDataFrame([(None, "none")], "d BIGINT, name STRING"))


def hot_hashes(spark):
    df = spark.createDataFrame([(1,), (None,)], "k BIGINT").select(F.xxhash64("k"))
    return dict(zip((r[0] for r in df.collect()), (5, 3)))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(spark, no_broadcast, how, null_safe):
    left, right = facts(spark), dims(spark)
    cond = F.col("k").eqNullSafe(F.col("d")) if null_safe else F.col("k") == F.col("d")
    want = left.join(right, cond, how)
    got = skew_join(left, right, ("k", "d"), how, null_safe=null_safe, hot=hot_hashes(spark))
    assert "_salt" in got._jdf.queryExecution().toString()
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_hot_key_is_spread(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = skew_join(facts(spark), dims(spark), ("k", "d"), hot=hot_hashes(spark))
        share = got.filter("k = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(share) > 1


def test_hot_keys_found_in_sample(spark):
    left = facts(spark, 60000)
    hot = find_hot_keys(left, F.xxhash64("k"), sample=0.05)
    assert set(hot) == set(hot_hashes(spark))
    # A third and a sixth of the rows, four pieces for each eighth, rounded up to powers of two.
    assert [hot[h] for h in hot_hashes(spark)] == [16, 8]
    even = spark.range(60000).select(F.xxhash64("id").alias("h"))
    assert find_hot_keys(even, F.col("h"), sample=0.05) == {}
    assert find_hot_keys(even.limit(0), F.col("h")) == {}


def test_detection_runs_by_itself(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(joins.find_hot_keys, "__defaults__", (0.05,))
    left, right = facts(spark, 60000), dims(spark)
    got = skew_join(left, right, ("k", "d"))
    assert "_salt" in got._jdf.queryExecution().toString()
    assert got.count() == left.join(right, F.col("k") == F.col("d")).count()


def test_small_right_side_is_left_to_spark(spark):
    got = skew_join(facts(spark), dims(spark).coalesce(1), ("k", "d"), hot=None)
    assert "_salt" not in got._jdf.queryExecution().toString()


def test_integer_keys_of_different_width(spark, no_broadcast):
    left = facts(spark)
    right = dims(spark).select(F.col("d").cast("int").alias("d"), "name")
    got = skew_join(left, right, ("k", "d"), hot=hot_hashes(spark))
    assert "_salt" in got._jdf.queryExecution().toString()
    assert rows(got) == rows(left.join(right, F.col("k") == F.col("d")))


def test_other_keys_must_have_one_type(spark):
    right = dims(spark).select(F.col("d").cast("string").alias("d"), "name")
    with pytest.raises(ValueError, match="one type"):
        skew_join(facts(spark), right, ("k", "d"))


def test_shared_key_name_comes_out_once(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k INT, x STRING")
    right = spark.createDataFrame([(1, "p"), (1, "q")], "k INT, y STRING")
    assert skew_join(left, right, "k").columns == ["k", "x", "y"]
    assert rows(skew_join(left, right, "k")) == [(1, "a", "p"), (1, "a", "q")]
    assert skew_join(left, right, "k", "left").count() == 4


def test_refuses_clashing_columns_and_other_types(spark):
    df = spark.createDataFrame([(1, 2)], "k INT, v INT")
    with pytest.raises(ValueError, match="both sides"):
        skew_join(df, df, "k")
    with pytest.raises(ValueError, match="join type"):
        skew_join(df, df.drop("v"), "k", "full")


def test_self_join(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    right = df.select("k", "v").withColumnRenamed("v", "w")
    assert rows(df.join(right, "k").select("k", "v", "w")) == [(1, "a", "a"), (2, "b", "b")]


def test_merge_takes_the_right_value(spark):
    staff = spark.createDataFrame(
        [("Ann", "HR", "old"), ("Bo", None, "old"), ("Cy", "IT", "old")], "name STRING, dept STRING, place STRING"
    )
    depts = spark.createDataFrame(
        [("HR", "north", 1), (None, "nowhere", 0), ("Ops", "south", 2)], "dept STRING, place STRING, heads INT"
    )
    columns = ["name", "dept", "place", "heads"]
    assert rows(merge_join(staff, depts, "dept", columns, null_safe=True)) == [
        ("Ann", "HR", "north", 1), ("Bo", None, "nowhere", 0),
    ]
    assert rows(merge_join(staff, depts, "dept", columns)) == [("Ann", "HR", "north", 1)]


def test_salt_does_not_depend_on_chance_or_row_order(spark, no_broadcast):
    left, right = facts(spark), dims(spark)
    salted = skew_join(left, right, ("k", "d"), hot=hot_hashes(spark))
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "rand" not in plan and "monotonically" not in plan


def test_copies_of_one_row_are_split(spark, no_broadcast):
    left = spark.range(0, 8000, 1, 8).select(F.lit(1).cast("bigint").alias("k"), F.lit("same").alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = skew_join(left, dims(spark), ("k", "d"), hot=hot_hashes(spark))
        share = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(share) == 8000 and len(share) > 1


@pytest.mark.parametrize("how", ["inner", "left"])
def test_nan_and_negative_zero_match_as_in_a_plain_join(spark, no_broadcast, how):
    nan = float("nan")
    zeros = [(-0.0, i) for i in range(4, 40)]
    left = spark.createDataFrame([(nan, 1), (1.0, 2), (None, 3), *zeros], "k DOUBLE, x INT")
    right = spark.createDataFrame([(nan, "n"), (1.0, "o"), (None, "z"), (0.0, "0")], "d DOUBLE, y STRING")
    hot = {r[0]: 4 for r in left.select(F.xxhash64("k")).distinct().collect()}
    got = skew_join(left, right, ("k", "d"), how, hot=hot).select("x", "y")
    assert rows(got) == rows(left.join(right, F.col("k") == F.col("d"), how).select("x", "y"))
    assert got.filter("y = 'n'").count() == 1 and got.filter("y = '0'").count() == 36


def test_salted_join_pushes_the_null_filter_down(spark, no_broadcast):
    path = "/root/testdata/sf0.001"
    left = spark.read.parquet(f"{path}/lineitem.parquet").select("l_partkey", "l_orderkey")
    right = spark.read.parquet(f"{path}/part.parquet").select("p_partkey", "p_brand")
    salted = skew_join(left, right, ("l_partkey", "p_partkey"), hot={1: 4})
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "_salt_left" in plan
    assert "PushedFilters: [IsNotNull(l_partkey)]" in plan
    assert "PushedFilters: [IsNotNull(p_partkey)]" in plan


def test_small_files_of_one_key_are_not_a_small_left_side(spark, tmp_path, monkeypatch):
    from tillwise.operators import joins

    monkeypatch.setattr(joins, "SMALL_LEFT", 20_000)
    spark.range(60_000).selectExpr("cast(1 as bigint) as k", "id % 3 as v").write.parquet(str(tmp_path / "l"))
    left = spark.read.parquet(str(tmp_path / "l"))
    assert joins.fits_broadcast(left) and not joins.few_rows(left)
    hot = joins.find_hot_keys(left, F.xxhash64("k"))
    assert len(hot) == 1 and joins.find_hot_keys(left, F.xxhash64("k")) == hot


def test_sample_size_does_not_grow_with_the_table(spark, tmp_path):
    from tillwise.operators import joins

    df = spark.range(10**12).selectExpr("id % 10 as k")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = joins.SAMPLE_PER_PARTITION * parts / joins.estimated_rows(df)
    assert 10**12 * share < 10 * joins.SAMPLE_PER_PARTITION * parts


def both_hot(spark, n=3000, m=900):
    """A third of either side under key 1; null is hot on both sides as well, and the right side has copies."""
    left = facts(spark, n)
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 6 == 1, F.lit(None)).otherwise(F.col("id") % 70)
    return left, spark.range(m).select(key.cast("bigint").alias("d"), (F.col("id") % 40).alias("v"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_key_that_is_hot_on_both_sides(spark, no_broadcast, monkeypatch, how, null_safe):
    monkeypatch.setattr(joins, "MOST_REPEATED", 100)
    monkeypatch.setattr(joins, "SMALL_LEFT", 0)
    left, right = both_hot(spark)
    cond = F.col("k").eqNullSafe(F.col("d")) if null_safe else F.col("k") == F.col("d")
    got = skew_join(left, right, ("k", "d"), how, null_safe=null_safe)
    assert "_left_column" in got._jdf.queryExecution().toString()
    assert got.columns == left.join(right, cond, how).columns
    assert rows(got) == rows(left.join(right, cond, how))


def test_left_rows_of_a_grid_without_a_match_come_out_once(spark, no_broadcast, monkeypatch):
    """The hash of a key is in the grid, the key itself is not on the right."""
    left, right = both_hot(spark, 600, 300)
    grid = {h: (4, 2) for h in hot_hashes(spark)}
    monkeypatch.setattr(joins, "_one_sided", lambda *_: ({}, grid))
    monkeypatch.setattr(joins, "few_rows", lambda _: False)
    monkeypatch.setattr(joins, "find_hot_keys", lambda *_: {1: 2})
    without = right.filter("d <> 1 OR d IS NULL")
    for null_safe in (False, True):
        cond = F.col("k").eqNullSafe(F.col("d")) if null_safe else F.col("k") == F.col("d")
        got = skew_join(left, without, ("k", "d"), "left", null_safe=null_safe)
        assert rows(got) == rows(left.join(without, cond, "left"))


def test_tasks_of_a_key_hot_on_both_sides_are_even(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(joins, "MOST_REPEATED", 100)
    monkeypatch.setattr(joins, "SMALL_LEFT", 0)
    left, right = both_hot(spark, 20000, 6000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew_join(left, right, ("k", "d"))
        found = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    made = sorted(r["count"] for r in found)
    assert sum(made) == left.join(right, F.col("k") == F.col("d")).count() > 13_000_000
    busy = made[-8:]  # the tasks of the hot key; those of the other keys follow in a union
    assert busy[-1] <= 3 * busy[3]


def test_cells_follow_the_sizes_of_both_sides(spark, monkeypatch):
    monkeypatch.setattr(joins, "MOST_REPEATED", 100)
    right = spark.range(1000).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("d"))
    key = right.select(F.xxhash64("d")).first()[0]
    few = joins._one_sided({key: 16}, 100, right, F.xxhash64("d"))
    many = joins._one_sided({key: 16}, 10_000_000, right, F.xxhash64("d"))
    assert few[0] == many[0] == {}
    for _, grid in (few, many):
        assert grid[key][0] * grid[key][1] == 16 * joins.CELLS
    assert many[1][key][1] < few[1][key][1]
    assert joins._one_sided({key: 16, 99: 8}, 100, right.filter("d > 1"), F.xxhash64("d")) == ({key: 16, 99: 8}, {})
