"""Sales reports over sales x customer x product.

Expected columns: sales(sales_id, order_id, product_id, quantity), orders(order_id, customer_id,
order_date), customers(customer_id, customer_name), products(product_id, product_name, description,
category, price). Each report sums on the join key first, so the join sees one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.numbers import minor_units
from tillwise.operators.aggregates import count_by, having
from tillwise.operators.joins import skew_join
from tillwise.operators.ranking import top_k


def sales_display(
    sales: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Every sale with its customer, product and order date. The narrow order columns are joined
    first, so that the wide product texts cross one exchange only."""
    with_customer = skew_join(orders, customers, "customer_id", spread=["order_id"])
    ordered = skew_join(
        sales, with_customer.select("order_id", "order_date", "customer_name"), "order_id", spread=spread
    )
    joined = skew_join(ordered, products, "product_id", spread=spread, keys_from=sales)
    return joined.select(
        "sales_id", "order_date", "customer_name", "product_name", "description", "category",
        "quantity", "price",
    )


def top_products(sales: DataFrame, products: DataFrame, k: int = 5, scale: int | None = None) -> DataFrame:
    """Products with the highest quantity x price; quantities are summed per product first, so each
    total is one product and nothing is rounded. With `scale` decimals the product is exact, and a
    price with more decimals fails the job."""
    sold = sales.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    priced = sold.join(products.select("product_id", "product_name", "price"), "product_id")
    price = F.col("price") if scale is None else minor_units(F.col("price"), scale)
    total = (F.col("quantity") * price).cast("double") / F.lit(1.0 if scale is None else float(10**scale))
    ranked = priced.select("product_id", F.col("product_name").alias("name"), total.alias("total_sales"))
    return top_k(ranked, "total_sales", ["product_id"], k)


def top_customers_by_orders(orders: DataFrame, customers: DataFrame, k: int = 5) -> DataFrame:
    counts = count_by(orders, ["customer_id"], "total_orders")
    named = counts.join(customers.select("customer_id", "customer_name"), "customer_id")
    return top_k(
        named.select("customer_id", "customer_name", "total_orders"), "total_orders", ["customer_id"], k
    )


def top_customers_by_sales(
    sales: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    min_quantity: int = 10,
    k: int = 2,
    scale: int | None = None,
) -> DataFrame:
    """Customers with at least `min_quantity` items, by total sales (sales need a `price` column).

    Sales are summed per order, then per customer; both joins see one row per key on either side or
    a sum that was combined before. Plain double sums unless `scale` gives the decimals of the money
    column: then the sums are exact and a finer amount fails the job."""
    amount = F.col("quantity") * F.col("price")
    per_order = sales.groupBy("order_id").agg(
        F.sum("quantity").alias("quantity"),
        F.sum(amount if scale is None else minor_units(amount, scale)).alias("amount"),
    )
    per_customer = (
        per_order.join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(F.sum("quantity").alias("total_quantity"), F.sum("amount").alias("amount"))
    )
    big = having(per_customer, F.col("total_quantity") >= min_quantity)
    total = F.col("amount").cast("double") / F.lit(1.0 if scale is None else float(10**scale))
    named = big.join(customers.select("customer_id", "customer_name"), "customer_id").select(
        "customer_id", "customer_name", total.alias("total_sales"), "total_quantity"
    )
    return top_k(named, "total_sales", ["customer_id"], k)
