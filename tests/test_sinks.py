import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwise.operators import quality
from tillwise.plans.retail import load_daily_folder, load_daily_table
from tillwise.session import shared_dir
from tillwise.sinks import files, tables
from tillwise.sources import schemas

PLACE = "id INT, v STRING"


@pytest.fixture
def name(spark, request):
    table = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(
    "output, source, safe",
    [
        ("/data/out", "/data/in.json", True),
        ("/data", "/data/in.json", False),
        ("/data/in.json", "/data/in.json", False),
        ("/data/in/out", "/data/in", False),
        ("/data/in2", "/data/in", True),
        ("file:/data", "file:///data/in.json", False),
        ("s3://b/", "s3://b/in.json", False),
        ("s3://c/", "s3://b/in.json", True),
        ("/data/x", "/data/*.json", False),
    ],
)
def test_output_guard(output, source, safe):
    if safe:
        files.check_output(output, [source])
    else:
        with pytest.raises(files.UnsafeOutput):
            files.check_output(output, [source])


def test_parquet_overwrite_and_guard_from_plan(spark, tmp_path):
    folder = str(tmp_path / "in")
    for n in (3, 2):
        files.write_parquet(spark.range(n).toDF("id"), folder)
    df = spark.read.parquet(folder)
    assert df.count() == 2
    with pytest.raises(files.UnsafeOutput):
        files.write_parquet(df, str(tmp_path))
    assert spark.read.parquet(folder).count() == 2


def failing(df):
    return df.select(F.when(F.col("id") == 900, F.raise_error(F.lit("late"))).otherwise(F.col("id")).alias("id"))


def test_failed_overwrite_leaves_the_old_rows(spark, tmp_path):
    folder = str(tmp_path / "out")
    files.write_parquet(spark.range(10), folder)
    with pytest.raises(Exception, match="late"):
        files.write_parquet(failing(spark.range(0, 1000, 1, 8)), folder)
    assert spark.read.parquet(folder).count() == 10
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_interrupted_change_of_folders_is_mended(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "a [b]")
    files.write_parquet(spark.range(10), folder)
    rename = files._rename
    monkeypatch.setattr(files, "_rename", lambda store, a, b: rename(store, a, b) if b.getName().endswith(".old") else exec("raise KeyboardInterrupt"))
    with pytest.raises(KeyboardInterrupt):
        files.write_parquet(spark.range(5), folder)
    monkeypatch.setattr(files, "_rename", rename)
    assert not (tmp_path / "a [b]").exists()
    assert files.restore_folder(spark, folder) and spark.read.parquet(folder.replace("[", "\\[").replace("]", "\\]")).count() == 10
    assert not files.restore_folder(spark, folder)


def test_failed_second_rename_is_undone(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")
    files.write_parquet(spark.range(10), folder)
    rename = files._rename

    def once(store, a, b):
        if a.getName().endswith(".new"):
            raise OSError("full")
        rename(store, a, b)

    monkeypatch.setattr(files, "_rename", once)
    with pytest.raises(OSError, match="full"):
        files.write_parquet(spark.range(5), folder)
    assert spark.read.parquet(folder).count() == 10


def test_overwrite_of_a_missing_folder_and_other_modes(spark, tmp_path):
    folder = str(tmp_path / "x" / "y")
    files.write_parquet(spark.range(2), folder)
    files.write_parquet(spark.range(3), folder, mode="append")
    assert spark.read.parquet(folder).count() == 5
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_parquet(spark.range(3), folder, mode="error")


def test_append_truncate(spark, tmp_path, name):
    df = spark.createDataFrame([(1, "a")], PLACE)
    for _ in range(2):
        tables.append_table(df, name, PLACE, str(tmp_path / "t"))
    assert rows(spark.table(name)) == [(1, "a"), (1, "a")]
    tables.truncate_table(df.select(F.col("v"), F.col("id")), name, PLACE, str(tmp_path / "t"))
    assert rows(spark.table(name)) == [(1, "a")]


def test_schema_and_required_columns(spark, tmp_path, name):
    place = str(tmp_path / "t")
    for bad in ("id BIGINT, v STRING", "id INT", "id INT, v STRING, w INT"):
        with pytest.raises(tables.SchemaMismatch):
            tables.append_table(spark.createDataFrame([], bad), name, PLACE, place)
    with_null = spark.createDataFrame([(1, None)], PLACE)
    with pytest.raises(Exception, match="null in required column v"):
        tables.append_table(with_null, name, PLACE, place, ["v"])
    assert spark.table(name).isEmpty()
    tables.append_table(with_null, name, PLACE, place)
    assert rows(spark.table(name)) == [(1, None)]


def test_replace_may_read_itself_and_change_columns(spark, tmp_path, name):
    place = str(tmp_path / "t")
    tables.replace_table(spark.createDataFrame([(1, "a")], PLACE), name, place)
    tables.replace_table(spark.table(name).select((F.col("id") + 1).alias("next")), name, place)
    assert spark.table(name).columns == ["next"] and rows(spark.table(name)) == [(2,)]
    broken = spark.table(name).select(F.raise_error(F.lit("boom")).cast("int").alias("x"))
    with pytest.raises(Exception, match="boom"):
        tables.replace_table(broken, name, place)
    assert rows(spark.table(name)) == [(2,)]


def test_replace_with_the_same_columns_moves_the_name(spark, tmp_path, name):
    place = str(tmp_path / "it's here")
    tables.replace_table(spark.createDataFrame([(1, "a")], PLACE), name, place)
    assert rows(spark.table(name)) == [(1, "a")]
    tables.replace_table(spark.table(name).withColumn("id", F.col("id") + 1), name, place)
    assert rows(spark.table(name)) == [(2, "a")]
    tables.replace_table(spark.table(name).unionByName(spark.table(name)), name, place)
    assert rows(spark.table(name)) == [(2, "a"), (2, "a")]
    tables.append_table(spark.createDataFrame([(3, "b")], PLACE), name, PLACE, place)
    assert spark.table(name).count() == 3


def daily(spark, *extra):
    days = [dt.date(2025, 6, d) for d in (1, 2, 3)]
    base = [(f"S{s}", f"C{c}", d, 1.5) for s in range(3) for c in range(2) for d in days]
    return spark.createDataFrame(
        base + list(extra), "store_id STRING, category_id STRING, transaction_date DATE, total_sales DOUBLE"
    )


def test_daily_table_truncates_every_day(spark, tmp_path, name):
    place = str(tmp_path / "t")
    load_daily_table(daily(spark), name, place)
    assert spark.table(name).count() == 18
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        load_daily_table(daily(spark).filter("transaction_date = DATE '2025-06-02'"), name, place)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert spark.table(name).select("transaction_date").distinct().count() == 1


def test_daily_table_prunes_partitions(spark, tmp_path, name):
    load_daily_table(daily(spark), name, str(tmp_path / "t"))
    one = spark.table(name).filter("transaction_date = DATE '2025-06-02'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan and "2025-06-02" in plan
    assert one.count() == 6
    assert quality.day_count(spark.table(name), "transaction_date", dt.date(2025, 6, 3)).first().n == 6


def test_undated_rows_go_to_quarantine_or_fail(spark, tmp_path, name):
    sales = daily(spark, ("S9", "C9", None, 2.5))
    with pytest.raises(Exception, match="null in required column transaction_date"):
        load_daily_table(sales, name, str(tmp_path / "t"))
    load_daily_table(sales, name, str(tmp_path / "t"), str(tmp_path / "bad"))
    assert spark.table(name).count() == 18
    assert rows(spark.read.parquet(str(tmp_path / "bad"))) == [("S9", "C9", None, 2.5)]


def test_daily_table_from_folder(spark, tmp_path, name):
    files.write_parquet(daily(spark), str(tmp_path / "agg"))
    load_daily_folder(spark, f"{tmp_path}/agg/*.parquet", name, str(tmp_path / "t"))
    assert spark.table(name).columns[-1] == "transaction_date" and spark.table(name).count() == 18


def test_failed_load_leaves_the_old_rows(spark, tmp_path, name):
    place = str(tmp_path / "t")
    load_daily_table(daily(spark), name, place)
    for bad in (daily(spark, ("S9", "C9", None, 2.5)), daily(spark).withColumn("total_sales", F.raise_error(F.lit("boom")).cast("double"))):
        with pytest.raises(Exception, match="boom|null in required"):
            load_daily_table(bad, name, place)
        assert spark.table(name).count() == 18
    other = f"{name}_flat"
    tables.truncate_table(spark.createDataFrame([(1, "a")], PLACE), other, PLACE, place)
    with pytest.raises(Exception, match="null in required"):
        tables.truncate_table(spark.createDataFrame([(1, None)], PLACE), other, PLACE, place, ["v"])
    assert rows(spark.table(other)) == [(1, "a")]
    # A table may be truncated from its own rows.
    tables.truncate_table(spark.table(other).withColumn("id", F.col("id") + 1), other, PLACE, place)
    tables.append_table(spark.createDataFrame([(9, "z")], PLACE), other, PLACE, place)
    assert rows(spark.table(other)) == [(2, "a"), (9, "z")]
    spark.sql(f"DROP TABLE {other}")


def test_hot_day_is_split_over_files(spark, tmp_path, name):
    hot = spark.range(40000).select(
        F.concat(F.lit("S"), F.col("id")).alias("store_id"),
        F.lit("C").alias("category_id"),
        F.when(F.col("id") % 3 == 0, F.lit("2025-06-01")).otherwise(
            F.concat(F.lit("2025-05-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))
        ).cast("date").alias("transaction_date"),
        F.lit(1.0).alias("total_sales"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load_daily_table(hot, name, str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list(tmp_path.glob("t-*/transaction_date=2025-06-01/*.parquet"))) > 1
    assert spark.table(name).count() == 40000


def test_empty_table_is_created_once(spark, tmp_path, name):
    for _ in range(2):
        tables.create_table(spark, name, schemas.DAILY_SALES, str(tmp_path / "t"), "transaction_date")
    assert spark.table(name).isEmpty()


def test_shared_dir_uses_the_cluster_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_checks(spark):
    with pytest.raises(quality.EmptyInput):
        quality.require_rows(spark.range(0))
    assert quality.require_rows(spark.range(1)).count() == 1
    quality.check_truthy(spark.range(1).selectExpr("1 AS n"))
    for bad in (spark.range(1).selectExpr("0 AS n"), spark.range(0)):
        with pytest.raises(quality.CheckFailed):
            quality.check_truthy(bad)
    good, bad = quality.split_required(spark.createDataFrame([(1, "a"), (2, None)], PLACE), ["id", "v"])
    assert rows(good) == [(1, "a")] and rows(bad) == [(2, None)]
    assert "id: integer" in quality.schema_report(good)
    assert quality.day_count(spark.range(3).select(F.current_date().alias("d")), "d").first().n == 3


def test_shared_dir_needs_a_setting_on_a_cluster():
    class Unset:
        conf = {}

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Unset, "x")


def test_output_guard_sees_through_spellings(spark, tmp_path, monkeypatch):
    """Relative, dotted, blank-holding and aliased paths leave the input alive."""
    monkeypatch.chdir(tmp_path)
    folder = tmp_path / "rel" / "x y"
    spark.range(3).toDF("id").write.parquet(str(folder))
    df = spark.read.parquet(str(folder))
    link = tmp_path / "link"
    link.symlink_to(tmp_path / "rel")
    for output in ("rel", "rel/../rel", f"{tmp_path}/a/../rel/x y", str(folder).replace(" ", "%20"), f"file://{folder}", str(link), "rel/x y/in"):
        with pytest.raises(files.UnsafeOutput):
            files.write_parquet(df, output)
        assert spark.read.parquet(str(folder)).count() == 3
    for output, source in (("s3a://b/in/x", "s3://b/in"), ("S3://b/a/../in", "s3n://b/in"), ("s3://b", "s3a://b/in/*.json")):
        with pytest.raises(files.UnsafeOutput):
            files.check_output(output, [source])
    files.write_parquet(df, str(tmp_path / "rel2"))
    assert files.scan_roots(df.join(spark.range(3), "id")) == [f"file:{folder}"]


def test_replace_across_partitioning(spark, tmp_path, name):
    place = str(tmp_path / "t")
    schema = "id INT, v STRING, day STRING"
    old = spark.createDataFrame([(1, "old", "d1"), (2, "old", "d2")], schema)
    new = spark.createDataFrame([(3, "new", "d3")], schema)
    tables.load_partitioned(old, name, schema, place, "day", ["id"])
    assert spark.table(name).count() == 2
    tables.replace_table(new, name, place)
    assert rows(spark.table(name)) == [(3, "new", "d3")]
    tables.load_partitioned(old, name, schema, place, "day", ["id"])
    tables.truncate_table(new, name, schema, place)
    assert rows(spark.table(name)) == [(3, "new", "d3")]
    tables.load_partitioned(old, name, schema, place, "day", ["id"])
    assert spark.table(name).count() == 2 and spark.table(name).filter("day = 'd2'").count() == 1
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]


def test_old_folders_go_by_request(spark, tmp_path, name):
    place = str(tmp_path / "t")
    for i in range(4):
        tables.truncate_table(spark.createDataFrame([(i, "x")], PLACE), name, PLACE, place)
    (tmp_path / "t-other").mkdir()
    assert len(list(tmp_path.iterdir())) == 5
    assert len(tables.remove_old_folders(spark, name, place, keep=1)) == 2
    assert rows(spark.table(name)) == [(3, "x")] and len(list(tmp_path.iterdir())) == 3
