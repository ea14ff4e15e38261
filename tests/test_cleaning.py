import pytest
from pyspark.sql import functions as F

from tillwise.functions.numbers import exact_sum, minor_units, one_percent, whole
from tillwise.functions.text import dash_to_null, dash_to_number, dotted_name
from tillwise.operators import aggregates, cleaning, dedup

STAFF = "id INT, dept STRING, pay DOUBLE"
ROWS = [(1, "a", 10.0), (2, "a", None), (3, "b", None), (4, None, 30.0), (5, None, None)]


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_drop_incomplete(spark):
    df = spark.createDataFrame(ROWS, STAFF)
    assert values(cleaning.drop_incomplete(df).select("id")) == [(1,)]
    assert values(cleaning.drop_incomplete(df, ["dept"]).select("id")) == [(1,), (2,), (3,)]


def test_fill_missing_leaves_other_columns(spark):
    df = cleaning.fill_missing(spark.createDataFrame(ROWS, STAFF), {"pay": 0.0})
    assert values(df.filter("id >= 3").select("id", "pay")) == [(3, 0.0), (4, 30.0), (5, 0.0)]
    assert df.filter("dept IS NULL").count() == 2


def test_null_counts_as_different(spark):
    df = spark.createDataFrame([("purchase",), ("view",), (None,)], "t STRING")
    assert df.filter(cleaning.differs("t", "purchase")).count() == 2
    assert df.filter(F.col("t") != "purchase").count() == 1
    assert df.filter(cleaning.equals("t", "purchase")).count() == 1


def test_usable_events(spark):
    df = spark.createDataFrame([("2025-01-01T00:00:00",), ("",), (None,)], "timestamp STRING")
    assert cleaning.usable_events(df).count() == 1


def test_means_with_groups_of_only_nulls(spark):
    df = spark.createDataFrame(ROWS, STAFF).filter("dept IS NOT NULL")
    assert values(aggregates.mean_of_present(df, "dept", "pay", "m")) == [("a", 10.0)]
    assert sorted(map(str, values_any(aggregates.mean_by(df, "dept", "pay", "m")))) == [
        "('a', 10.0)", "('b', None)",
    ]


def values_any(df):
    return [tuple(r) for r in df.collect()]


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([("k", 2.675), ("k", 2.675)], "k STRING, v DOUBLE")
    assert aggregates.rounded_mean(df, "k", "v", "m").first().m == 2.68


def test_distinct_with_and_without_null(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "v STRING")
    assert aggregates.distinct_present(df, "v").first().n == 2
    assert aggregates.distinct_with_null(df, "v").first().n == 3


def test_exact_sum_does_not_depend_on_order(spark):
    parts = [(float(i % 97) + 0.1,) for i in range(5000)] + [(1e9 + 0.01,)]
    want = round(sum(round(p[0] * 100) for p in parts)) / 100
    for rows in (parts, parts[::-1]):
        df = spark.createDataFrame(rows, "v DOUBLE").repartition(7)
        assert df.agg(exact_sum(F.col("v")).alias("s")).first().s == want


def test_whole_rounds_halves_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (2.4,), (None,)], "v DOUBLE")
    got = [r[0] for r in df.select(whole(F.col("v"))).collect()]
    assert got == [3, -3, 2, None]
    taxed = [r[0] for r in df.select(one_percent(F.col("v"))).collect()]
    assert taxed == [0.03, -0.03, 0.02, None]


def test_dashes_and_names(spark):
    df = spark.createDataFrame([("-", "a"), ("12", None), ("x-", "b")], "v STRING, n STRING")
    assert [r[0] for r in df.select(dash_to_null("v")).collect()] == [None, "12", "x-"]
    assert [r[0] for r in df.select(dash_to_number("v")).collect()] == [None, 12, None]
    assert [r[0] for r in df.select(dotted_name("v", "n")).collect()] == ["-.a", None, "x-.b"]


def test_words_keep_empty_pieces(spark):
    df = spark.createDataFrame([("a  b",), ("a",), (None,)], "t STRING")
    assert values(aggregates.word_counts(df, "t")) == [("", 1), ("a", 2), ("b", 1)]


def test_duplicates(spark):
    rows = [(1, None), (1, None), (1, "x"), (2, "x")]
    df = spark.createDataFrame(rows, "a INT, b STRING")
    assert dedup.distinct_rows(df).count() == 3
    assert values(dedup.first_per_key(df, ["a"], ["b"]).select("a")) == [(1,), (2,)]
    assert dedup.first_per_key(df, ["b"], [F.desc("a")]).filter("b = 'x'").first().a == 2
    assert values(dedup.distinct_values(df, "a")) == [(1,), (2,)]


@pytest.mark.parametrize("amount,units", [(600000.004, None), (6000000000.004, None), (6000000000.01, 600000000001), (0.1 + 0.2, 30), (7 * 1234567.89, 864197523)])
def test_minor_units_refuse_more_decimals_at_any_size(spark, amount, units):
    df = spark.createDataFrame([(amount,)], "v double").select(minor_units(F.col("v")).alias("u"))
    if units is None:
        with pytest.raises(Exception, match="more than 2 decimals"):
            df.collect()
    else:
        assert df.first().u == units
