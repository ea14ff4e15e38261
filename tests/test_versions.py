import threading

import pytest
from pyspark.sql import functions as F

from tillwise.sinks import versions


@pytest.fixture
def name(spark, request):
    made = "p_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    yield made
    spark.sql(f"DROP VIEW IF EXISTS {made}")
    for version in versions.versions(spark, made):
        spark.sql(f"DROP TABLE {version}")


def numbered(spark, version, n=200):
    return spark.range(n).select("id", F.lit(version).alias("version"), (F.col("id") % 3).alias("day"))


def test_versions_of_any_layout(spark, tmp_path, name):
    place = str(tmp_path / "t")
    versions.publish(numbered(spark, 1), name, place, "day", ["id"])
    assert spark.table(name).filter("day = 1").count() == 67
    plan = spark.table(name).filter("day = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    versions.publish(spark.table(name).select("id", F.lit("x").alias("other")), name, place)
    assert spark.table(name).columns == ["id", "other"] and spark.table(name).count() == 200
    versions.publish(numbered(spark, 3, 5), name, place, "day")
    assert spark.table(name).count() == 5
    assert len(versions.versions(spark, name)) == 3
    assert versions.current_version(spark, name) == versions.versions(spark, name)[-1]


def test_readers_see_whole_versions_only(spark, tmp_path, name):
    place = str(tmp_path / "t")
    versions.publish(numbered(spark, 0), name, place)
    seen, failed, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                rows = spark.table(name).agg(F.count("*"), F.count_distinct("version"), F.max("version")).first()
                seen.append(tuple(rows))
            except Exception as error:
                failed.append(str(error)[:300])

    reader = threading.Thread(target=read)
    reader.start()
    for version in range(1, 7):
        versions.publish(numbered(spark, version), name, place, "day" if version % 2 else None)
    done.set()
    reader.join()
    assert failed == []
    assert {s[:2] for s in seen} == {(200, 1)}
    assert [s[2] for s in seen] == sorted(s[2] for s in seen)


def test_failed_load_leaves_the_version_before(spark, tmp_path, name):
    place = str(tmp_path / "t")
    versions.publish(numbered(spark, 1), name, place)
    broken = numbered(spark, 2).withColumn("id", F.when(F.col("id") == 150, F.raise_error(F.lit("late"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="late"):
        versions.publish(broken, name, place)
    with pytest.raises(Exception):
        versions.publish(numbered(spark, 2).withColumn("day", F.lit(None).cast("int")), name, place, not_null=["day"])
    assert spark.table(name).select("version").distinct().collect()[0].version == 1
    assert versions.current_version(spark, name) == versions.versions(spark, name)[0]


def test_old_versions_are_removed_on_request(spark, tmp_path, name):
    place = str(tmp_path / "t")
    made = [versions.publish(numbered(spark, v), name, place) for v in range(4)]
    assert versions.remove_old_versions(spark, name, keep=1) == made[:2]
    assert versions.versions(spark, name) == made[2:] and spark.table(name).count() == 200
    assert len(list(tmp_path.iterdir())) == 2
    assert versions.remove_old_versions(spark, name, keep=0) == made[2:3]


def test_names_of_other_things_are_refused(spark, tmp_path, name):
    spark.range(3).write.saveAsTable(f"{name}_t", path=str(tmp_path / "plain"))
    spark.sql(f"CREATE VIEW {name}_v AS SELECT 1 AS x")
    try:
        for taken in (f"{name}_t", f"{name}_v"):
            assert versions.current_version(spark, taken) is None
            with pytest.raises(versions.NotPublished):
                versions.publish(numbered(spark, 1), taken, str(tmp_path / "t"))
        assert versions.current_version(spark, f"{name}_none") is None
    finally:
        spark.sql(f"DROP TABLE {name}_t")
        spark.sql(f"DROP VIEW {name}_v")
