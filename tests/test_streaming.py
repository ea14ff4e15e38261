import json

from tillwise.streaming.clickstream import append_new_files, daily_counts, stream_lines


def click(kind, when, product="P1"):
    return json.dumps({"event_type": kind, "product_id": product, "user_id": "U", "timestamp": when})


def run(spark, tmp_path):
    places = [str(tmp_path / p) for p in ("out", "bad", "check")]
    query = append_new_files(stream_lines(spark, str(tmp_path / "in")), *places)
    assert query.awaitTermination(120)
    assert query.exception() is None
    return sorted(tuple(r) for r in daily_counts(spark, places[0]).collect())


def test_each_file_is_counted_once_and_late_events_count(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    first = [
        click("purchase", "2025-06-11T05:00:00"), click(None, "2025-06-11T06:00:00"),
        click("view", "bad"), click("view", "2025-06-12T03:00:00"), "{broken",
    ]
    (folder / "a.json").write_text("\n".join(first))
    want = [("2025-06-11", "P1", 1, 1), ("2025-06-12", "P1", 0, 1)]
    assert run(spark, tmp_path) == want
    assert run(spark, tmp_path) == want
    late = [click("purchase", "2025-06-11T07:00:00"), click("view", "2025-06-13T09:00:00")]
    (folder / "b.json").write_text("\n".join(late))
    assert run(spark, tmp_path) == [("2025-06-11", "P1", 2, 1), ("2025-06-12", "P1", 0, 1), ("2025-06-13", "P1", 0, 1)]
    reasons = sorted(r.reject_reason for r in spark.read.parquet(str(tmp_path / "bad")).collect())
    assert reasons == ["bad timestamp", "malformed json"]


def test_days_do_not_depend_on_the_session_zone(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join([click("view", "2025-06-11T00:30:00"), click("view", "2025-06-11T23:30:00")]))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert run(spark, tmp_path) == [("2025-06-11", "P1", 0, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
