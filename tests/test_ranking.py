from tillwise.operators import ranking
from tillwise.operators.aggregates import having


def test_second_row_and_second_value_differ_on_ties(spark):
    df = spark.createDataFrame([(1, 80), (2, 80), (3, 70), (4, None)], "id INT, pay INT")
    row = ranking.second_row(df, "pay", ["id"]).collect()
    assert [tuple(r) for r in row] == [(2, 80, 2)]
    assert ranking.second_highest(df, "pay").first()[0] == 70


def test_second_value_needs_two(spark):
    for rows in ([], [(5,)], [(5,), (5,), (None,)]):
        got = ranking.second_highest(spark.createDataFrame(rows, "v INT"), "v").collect()
        assert [tuple(r) for r in got] == [(None,)]
    assert ranking.second_row(spark.createDataFrame([(1, 5)], "id INT, v INT"), "v", ["id"]).isEmpty()


def test_top_k(spark):
    df = spark.createDataFrame([("a", 2), ("b", 3), ("c", 2), ("d", 1)], "w STRING, n INT")
    assert [tuple(r) for r in ranking.top_k(df, "n", ["w"], 3).collect()] == [("b", 3), ("a", 2), ("c", 2)]
    listed = ranking.top_k_list(df, "n", ["w"], 3).first().top
    assert [tuple(e) for e in listed] == [("b", 3), ("a", 2), ("c", 2)]
    assert ranking.top_k_list(df.limit(0), "n", ["w"], 3).first().top == []


def test_having(spark):
    df = spark.createDataFrame([("a", 9), ("b", 10)], "w STRING, q INT")
    assert [r.w for r in having(df, df.q >= 10).collect()] == ["b"]
