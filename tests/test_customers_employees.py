import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwise.plans import customers, employees
from tillwise.sources.schemas import CUSTOMER_RAW, DEPARTMENTS, EMPLOYEES


@pytest.fixture
def names(spark):
    tables = ("load_a", "load_b", "load_c")
    yield tables
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


STAMP = "2024-05-06 07:08:09"
RAW = ("C1", "Acme", STAMP, None, "2024-1-2 3:4:5", "u", STAMP, "v", "007")


def test_one_source_column_gives_date_and_datetime(spark):
    df = customers.typed_customers(spark.createDataFrame([RAW], CUSTOMER_RAW))
    assert [t for _, t in df.dtypes] == [
        "string", "string", "date", "date", "date", "string", "date", "string",
        *["timestamp_ntz"] * 4, "string",
    ]
    row = df.first()
    assert row.start_ts == dt.date(2024, 5, 6) and row.start_timestamp == dt.datetime(2024, 5, 6, 7, 8, 9)
    assert row.end_ts is None and row.end_timestamp is None
    assert row.create_timestamp == dt.datetime(2024, 1, 2, 3, 4, 5)
    kept = customers.typed_customers(spark.createDataFrame([RAW], CUSTOMER_RAW), as_date=False)
    assert dict(kept.dtypes)["start_ts"] == "timestamp_ntz"


def test_load_customers(spark, tmp_path, names):
    path = tmp_path / "c.csv"
    path.write_text("cust_id,cust_name,a,b,c,new_user_id,d,e,f\n" + ",".join(x or STAMP for x in RAW) + "\n")
    for _ in range(2):
        customers.load_customers(spark, str(path), names[0], names[1], str(tmp_path / "t"))
    assert rows(spark.table(names[0])) == [tuple(x or STAMP for x in RAW)]
    assert spark.table(names[1]).first().last_update_ts == dt.date(2024, 5, 6)


def test_load_into_two_databases(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("a,b,c,d,e,f,g,h,i\n" + ",".join(x or STAMP for x in RAW) + "\n")
    for layer in ("raw_layer", "insight_layer"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{tmp_path}/{layer}'")
    customers.load_customers(spark, str(path), "raw_layer.customer", "insight_layer.customer", str(tmp_path / "t"))
    assert spark.table("insight_layer.customer").count() == 1
    for layer in ("raw_layer", "insight_layer"):
        spark.sql(f"DROP DATABASE {layer} CASCADE")


def test_other_layout_fails_and_keeps_the_old_table(spark, tmp_path, names):
    good, bad = tmp_path / "g.csv", tmp_path / "b.csv"
    good.write_text("h1,h2,h3,h4,h5,h6,h7,h8,h9\n" + ",".join(x or STAMP for x in RAW) + "\n")
    bad.write_text("h1,h2,h3,h4,h5,h6,h7,h8,h9\nC2,X,01-01-2024 08:00,,,u,,v,1\n")
    customers.load_customers(spark, str(good), names[0], names[1], str(tmp_path / "t"))
    with pytest.raises(Exception, match="bad datetime: 01-01-2024 08:00"):
        customers.load_customers(spark, str(bad), names[0], names[1], str(tmp_path / "t"))
    assert spark.table(names[1]).first().customer_nbr == "C1"


STAFF = [
    (1, "Ann", "Lee", "a@x", 10, 1000.5, "2024-01-01"),
    (2, "Bo", None, "b@x", 10, 999.49, "2024-01-02"),
    (3, "Cy", "Fox", "c@x", 99, None, None),
    (4, "Di", "Ray", "d@x", None, 2.5, "x"),
    (None, "No", "Id", "n@x", 10, 1.0, "x"),
]


def test_enrich(spark):
    emp = spark.createDataFrame(STAFF, EMPLOYEES)
    dep = spark.createDataFrame([(10, "HR"), (20, "IT"), (None, "None")], DEPARTMENTS)
    assert rows(employees.enrich(emp, dep)) == [
        (1, "Ann.Lee", "a@x", 1000.5, "2024-01-01", 10, "HR", 1001 * 0.01),
        (2, None, "b@x", 999.49, "2024-01-02", 10, "HR", 999 * 0.01),
        (3, "Cy.Fox", "c@x", None, None, None, None, None),
        (4, "Di.Ray", "d@x", 2.5, "x", None, None, 3 * 0.01),
    ]


def test_load_employees(spark, tmp_path, names):
    emp, dep = tmp_path / "e.csv", tmp_path / "d.csv"
    emp.write_text("1,Ann,Lee,a@x,10,1000.5,2024-01-01\n")
    dep.write_text("10,HR\n")
    employees.load_employees(spark, str(emp), str(dep), str(tmp_path / "t"), *names)
    assert spark.table(names[2]).select(F.col("FullName"), F.col("DepartmentName")).first()[:] == ("Ann.Lee", "HR")


def test_empty_timestamp_fails_the_typed_load(spark, tmp_path):
    from tillwise.plans.customers import typed_customers
    from tillwise.sources.files import read_csv
    from tillwise.sources.schemas import CUSTOMER_RAW

    path = tmp_path / "c.csv"
    path.write_text("a,b,c,d,e,f,g,h,i\nC1,Acme,,2024-01-01 00:00:00,2024-01-01 00:00:00,u,2024-01-01 00:00:00,v,1\n")
    raw = read_csv(spark, str(path), CUSTOMER_RAW)
    assert raw.first().start_ts == ""
    try:
        typed_customers(raw).collect()
    except Exception as failed:
        assert "bad datetime" in str(failed)
    else:
        raise AssertionError("an empty timestamp passed")
