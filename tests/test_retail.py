import datetime as dt
import json

import pytest

from tillwise.plans import retail
from tillwise.sinks.files import UnsafeOutput

DAY = dt.date(2025, 6, 1)


def sale(i, store="S1", category="C1", quantity=2, price=10.5, when="2025-06-01T08:00:00.25", customer="K"):
    return {
        "transaction_id": f"T{i}", "store_id": store, "category_id": category, "quantity": quantity,
        "price": price, "timestamp": when, "customer_id": customer,
    }


SALES = [
    sale(1),
    sale(2, quantity=1, price=0.1),
    sale(3, quantity=1, price=0.2),
    sale(4, store="S2", when="2025-06-02"),
    sale(5, customer=None),
    sale(6, price=None),
    sale(7, when="yesterday"),
    sale(8, category="C2", quantity=3, price=19.99),
]


@pytest.fixture
def lines(tmp_path):
    path = tmp_path / "in" / "sales.json"
    path.parent.mkdir()
    path.write_text("\n".join(map(json.dumps, SALES)))
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_daily_sales_with_and_without_customer(spark, lines):
    tx = retail.read_transactions(spark, lines)
    want = [
        ("S1", "C1", DAY, 42.3),
        ("S1", "C1", None, 21.0),
        ("S1", "C2", DAY, 59.97),
        ("S2", "C1", dt.date(2025, 6, 2), 21.0),
    ]
    assert rows(retail.daily_sales(tx, scale=2)) == sorted(want, key=str)
    all_columns = {r[:3]: r[3] for r in rows(retail.daily_sales(tx, complete=None, scale=2))}
    assert all_columns[("S1", "C1", DAY)] == 21.3


def test_plain_sum_is_close_to_the_exact_one(spark, lines):
    tx = retail.read_transactions(spark, lines).drop("_corrupt_record")
    exact = {r[:3]: r[3] for r in rows(retail.daily_sales(tx, scale=2))}
    for key, total in ((r[:3], r[3]) for r in rows(retail.daily_sales(tx))):
        assert total == pytest.approx(exact[key], abs=1e-9)


def test_amount_transactions(spark):
    data = [("T1", "S1", "C1", 1.1, "2025-06-01T00:00:00"), ("T2", "S1", "C1", 2.2, "2025-06-01"), ("T3", "S1", "C1", None, "2025-06-01")]
    df = spark.createDataFrame(data, "transaction_id STRING, store_id STRING, category_id STRING, amount DOUBLE, timestamp STRING")
    assert rows(retail.amount_sales(df, scale=2)) == [("S1", "C1", DAY, 3.3)]


@pytest.mark.parametrize("layout", ["lines", "array", "flat_array"])
def test_run_reports_every_stage(spark, tmp_path, layout):
    path = tmp_path / "in" / "sales.json"
    path.parent.mkdir()
    if layout == "lines":
        path.write_text("\n".join(map(json.dumps, SALES)) + '\n{"broken": \n')
    else:
        path.write_text(json.dumps(SALES, indent=2))
    out = str(tmp_path / "out")
    report = retail.run_daily_sales(spark, str(path), out, layout)
    corrupt = int(layout == "lines")
    assert report == retail.SalesReport("written", 8 + corrupt, corrupt, 7, 1, 4)
    back = spark.read.parquet(out)
    assert back.columns == ["store_id", "category_id", "transaction_date", "total_sales"]
    assert back.count() == 4


def test_run_stops_on_no_data_and_on_unsafe_output(spark, tmp_path, lines):
    empty = tmp_path / "empty.json"
    empty.write_text("[]")
    assert retail.run_daily_sales(spark, str(empty), str(tmp_path / "o"), "array").status == "no data"
    assert not (tmp_path / "o").exists()
    with pytest.raises(UnsafeOutput):
        retail.run_daily_sales(spark, lines, str(tmp_path / "in"))
    assert len(retail.read_transactions(spark, lines).collect()) == 8


@pytest.mark.parametrize("text, corrupt", [('{"store_id": "S1"}\n{"store_id": "S2"}', 0), ("garbage\nmore", 2)])
def test_run_that_drops_every_row(spark, tmp_path, text, corrupt):
    path = tmp_path / "sales.json"
    path.write_text(text)
    out = str(tmp_path / "o")
    assert retail.run_daily_sales(spark, str(path), out) == retail.SalesReport("written", 2, corrupt)
    assert spark.read.parquet(out).columns == ["store_id", "category_id", "transaction_date", "total_sales"]


def test_run_with_inferred_schema(spark, tmp_path):
    path = tmp_path / "sales.json"
    path.write_text(json.dumps(SALES, indent=1))
    report = retail.run_daily_sales(spark, str(path), str(tmp_path / "o"), "array", schema=None)
    assert (report.status, report.kept, report.groups) == ("written", 7, 4)
    broken = tmp_path / "broken.json"
    broken.write_text("nothing here")
    assert retail.run_daily_sales(spark, str(broken), str(tmp_path / "p"), schema=None).status == "no data"


def test_unknown_layout(spark):
    with pytest.raises(ValueError, match="layout"):
        retail.read_transactions(spark, "x", "xml")
