"""Declared schemas of the inputs and the sinks, as DDL text."""

from __future__ import annotations

# Column names, order and types of the input files.
TRANSACTIONS = (
    "transaction_id STRING, store_id STRING, category_id STRING, quantity INT, price DOUBLE, "
    "timestamp STRING, customer_id STRING"
)
AMOUNT_TRANSACTIONS = (
    "transaction_id STRING, store_id STRING, category_id STRING, amount DOUBLE, timestamp STRING"
)
CLICK_EVENTS = "event_type STRING, product_id STRING, user_id STRING, timestamp STRING"
CUSTOMER_RAW = (
    "customer_nbr STRING, customer_desc STRING, start_ts STRING, end_ts STRING, create_ts STRING, "
    "create_user_id STRING, last_update_ts STRING, last_update_user_id STRING, client_id STRING"
)
EMPLOYEES = (
    "EmployeeID BIGINT, FirstName STRING, LastName STRING, Email STRING, DepartmentID BIGINT, "
    "Salary DOUBLE, JoinDate STRING"
)
DEPARTMENTS = "DepartmentID BIGINT, DepartmentName STRING"
USER_SESSIONS = (
    "user_id STRING, name STRING, location STRUCT<city: STRING, country: STRING>, "
    "sessions ARRAY<STRUCT<session_id: STRING, start_time: STRING, "
    "page_views: ARRAY<STRUCT<page: STRING, duration: BIGINT>>>>"
)

# Columns that must be present for a transaction to count (customer_id may be null).
TRANSACTION_KEYS = (
    "transaction_id", "store_id", "category_id", "quantity", "price", "timestamp",
)

# Sink columns, and which of them may not be null.
DAILY_SALES = "store_id STRING, category_id STRING, total_sales DOUBLE, transaction_date DATE"
DAILY_SALES_REQUIRED = ("store_id", "category_id", "transaction_date")
PURCHASES = "event_date STRING, product_id STRING, purchase_count BIGINT"
PURCHASES_REQUIRED = ("event_date", "product_id", "purchase_count")
NOT_PURCHASED = "event_date STRING, product_id STRING, not_purchased_count BIGINT"
NOT_PURCHASED_REQUIRED = ("event_date", "product_id", "not_purchased_count")
ABANDONED = "event_date STRING, product_id STRING, abandoned_count BIGINT"
ABANDONED_REQUIRED = ("event_date", "product_id", "abandoned_count")
TRENDS = "event_date DATE, product_id STRING, purchase_count BIGINT"

# Warehouse type -> Spark type.
WAREHOUSE_TYPES = {
    "STRING": "STRING",
    "INTEGER": "BIGINT",
    "INT64": "BIGINT",
    "FLOAT": "DOUBLE",
    "FLOAT64": "DOUBLE",
    "BOOLEAN": "BOOLEAN",
    "DATE": "DATE",
    "DATETIME": "TIMESTAMP_NTZ",
    "TIMESTAMP": "TIMESTAMP",
}


def from_compact(text: str) -> str:
    """DDL of a schema written as `name:TYPE, name:TYPE`."""
    pairs = [part.split(":") for part in text.split(",")]
    return ", ".join(f"{name.strip()} {WAREHOUSE_TYPES[kind.strip().upper()]}" for name, kind in pairs)


def from_fields(fields: list[dict[str, str]]) -> tuple[str, tuple[str, ...]]:
    """DDL and required columns of a schema given as a list of name, type and mode."""
    ddl = ", ".join(f"{f['name']} {WAREHOUSE_TYPES[f['type'].upper()]}" for f in fields)
    return ddl, tuple(f["name"] for f in fields if f.get("mode", "NULLABLE").upper() == "REQUIRED")
