import datetime as dt

import pytest

from tillwise.plans import reports


@pytest.fixture(scope="module")
def star(spark):
    sales = spark.createDataFrame(
        [(1, 1, 1, 1, 250.0), (2, 2, 2, 5, 100.0), (3, 3, 3, 10, 40.0), (4, 4, 2, 1, 100.0), (5, 9, 1, 1, 250.0), (6, 1, 8, 1, 1.0)],
        "sales_id INT, order_id INT, product_id INT, quantity INT, price DOUBLE",
    )
    day = dt.date(2024, 1, 1)
    orders = spark.createDataFrame([(1, 1, day), (2, 1, day), (3, 2, day), (4, 3, day), (5, 7, day)], "order_id INT, customer_id INT, order_date DATE")
    customers = spark.createDataFrame([(1, "Ann"), (2, "Bo"), (3, "Cy")], "customer_id INT, customer_name STRING")
    products = spark.createDataFrame(
        [(1, "Lamp", "desk lamp", "Home", 250.0), (2, "Shoe", "runner", "Wear", 100.0), (3, "Pen", "ink", "Office", 40.0)],
        "product_id INT, product_name STRING, description STRING, category STRING, price DOUBLE",
    )
    return sales, orders, customers, products


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_display(star):
    sales, orders, customers, products = star
    got = sorted(rows(reports.sales_display(sales.drop("price"), orders, customers, products)))
    assert [r[0] for r in got] == [1, 2, 3, 4]
    assert got[1][1:] == (dt.date(2024, 1, 1), "Ann", "Shoe", "runner", "Wear", 5, 100.0)


def test_top_products(star):
    sales, _, _, products = star
    assert rows(reports.top_products(sales, products)) == [(2, "Shoe", 600.0), (1, "Lamp", 500.0), (3, "Pen", 400.0)]
    assert rows(reports.top_products(sales, products, 1)) == [(2, "Shoe", 600.0)]


def test_top_customers_by_orders(star):
    _, orders, customers, _ = star
    # The order of customer 7, who is not in the customer table, does not count.
    assert rows(reports.top_customers_by_orders(orders, customers)) == [(1, "Ann", 2), (2, "Bo", 1), (3, "Cy", 1)]


def test_top_customers_by_sales_needs_the_quantity(star):
    sales, orders, customers, _ = star
    assert rows(reports.top_customers_by_sales(sales, orders, customers)) == [(2, "Bo", 400.0, 10)]
    both = reports.top_customers_by_sales(sales, orders, customers, min_quantity=7)
    assert rows(both) == [(1, "Ann", 751.0, 7), (2, "Bo", 400.0, 10)]


def test_prices_are_not_rounded_before_they_are_multiplied(spark):
    sales = spark.createDataFrame([(1, 1, 1, 1000), (2, 1, 2, 1000)], "sales_id INT, order_id INT, product_id INT, quantity INT")
    products = spark.createDataFrame([(1, "A", 0.125), (2, "B", 0.124)], "product_id INT, product_name STRING, price DOUBLE")
    assert rows(reports.top_products(sales, products)) == [(1, "A", 125.0), (2, "B", 124.0)]
    with pytest.raises(Exception, match="more than 2 decimals"):
        reports.top_products(sales, products, scale=2).collect()


def test_small_line_totals_add_up(spark):
    sales = spark.createDataFrame([(1, 1, 0.004)] * 1000, "order_id INT, quantity INT, price DOUBLE")
    orders = spark.createDataFrame([(1, 7)], "order_id INT, customer_id INT")
    customers = spark.createDataFrame([(7, "Gil")], "customer_id INT, customer_name STRING")
    assert rows(reports.top_customers_by_sales(sales, orders, customers))[0][2] == pytest.approx(4.0)
    assert rows(reports.top_customers_by_sales(sales, orders, customers, scale=3)) == [(7, "Gil", 4.0, 1000)]
    with pytest.raises(Exception, match="more than 2 decimals"):
        reports.top_customers_by_sales(sales, orders, customers, scale=2).collect()
