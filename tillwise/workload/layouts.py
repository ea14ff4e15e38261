"""File layouts: tables written out by Spark in every supported layout and read back."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators.cleaning import drop_blank_rows
from tillwise.session import shared_dir
from tillwise.sinks.files import write_parquet
from tillwise.sources.files import CORRUPT, read_csv, read_json, read_json_array, read_parquet
from tillwise.workload.registry import query, table


def _customer_csv(spark, sf_dir) -> str:
    folder = shared_dir(spark, "customer-csv")
    table(spark, sf_dir, "customer").write.option("header", True).csv(folder)
    return folder


@query("""
SELECT cast(c_custkey AS varchar) AS customer_nbr, c_name AS customer_desc,
       cast(c_nationkey AS varchar) AS start_ts, cast(c_acctbal AS varchar) AS end_ts,
       c_mktsegment AS create_ts
FROM customer
""")
def csv_positional(spark, sf_dir):
    """All-text columns renamed by position, whatever the header says."""
    names = "customer_nbr STRING, customer_desc STRING, start_ts STRING, end_ts STRING, create_ts STRING"
    return read_csv(spark, _customer_csv(spark, sf_dir), names)


@query("SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS salary, c_mktsegment AS segment FROM customer")
def csv_typed(spark, sf_dir):
    schema = "id BIGINT, name STRING, nation INT, salary DOUBLE, segment STRING"
    return read_csv(spark, _customer_csv(spark, sf_dir), schema)


@query("SELECT c_custkey, c_name, cast(c_nationkey AS bigint) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_inferred(spark, sf_dir):
    """Whole numbers are inferred as INT or BIGINT, whichever they need."""
    inferred = read_csv(spark, _customer_csv(spark, sf_dir))
    return inferred.withColumns({c: F.col(c).cast("bigint") for c in ("c_custkey", "c_nationkey")})


@query("""
SELECT cast(c_custkey AS varchar) AS customer_nbr, CASE WHEN c_nationkey < 12 THEN '' ELSE c_name END AS customer_desc,
       cast(c_nationkey AS varchar) AS start_ts, '' AS end_ts
FROM customer
""")
def csv_empty_text(spark, sf_dir):
    """A raw load keeps empty fields as empty texts."""
    folder = shared_dir(spark, "empty-csv")
    name = F.when(F.col("c_nationkey") < 12, F.lit("")).otherwise(F.col("c_name"))
    table(spark, sf_dir, "customer").select("c_custkey", name.alias("a"), "c_nationkey", F.lit(None).cast("string").alias("b")).write.option("header", True).csv(folder)
    return read_csv(spark, folder, "customer_nbr STRING, customer_desc STRING, start_ts STRING, end_ts STRING")


def _blank_csv(spark, sf_dir) -> str:
    folder = shared_dir(spark, "blank-csv")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.concat_ws("\n", "c_name", "c_mktsegment").alias("address"),
        F.col("c_acctbal").cast("string").alias("c_acctbal"),
    )
    blank = F.struct(*[F.lit(None).cast("string").alias(c) for c in rows.columns])
    pair = F.explode(F.array(F.struct(*rows.columns), blank)).alias("r")
    rows.select(pair).select("r.*").write.option("header", True).csv(folder)
    return folder


_BLANK_SQL = "SELECT c_custkey, c_name || chr(10) || c_mktsegment AS address, c_acctbal FROM customer"
_BLANK = "c_custkey BIGINT, address STRING, c_acctbal DOUBLE"


@query(_BLANK_SQL)
def blank_rows_removed(spark, sf_dir):
    """Quoted line breaks, and a blank row after each customer."""
    return drop_blank_rows(read_csv(spark, _blank_csv(spark, sf_dir), _BLANK, multi_line=True))


@query(_BLANK_SQL)
def csv_split_records(spark, sf_dir):
    """The same, of records that many tasks cut out of the files."""
    return drop_blank_rows(read_csv(spark, _blank_csv(spark, sf_dir), _BLANK, multi_line=True, split=True))


_ORDERS = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders"
_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")


def _order_lines(spark, sf_dir) -> str:
    folder = shared_dir(spark, "order-lines")
    table(spark, sf_dir, "orders").select(*_ORDER_COLUMNS).write.json(folder)
    return folder


def write_json_arrays(df: DataFrame, folder: str) -> None:
    """Text files that each hold one array, a record per line; one file per task."""
    write_element_arrays(df.select(F.to_json(F.struct(*df.columns)).alias("value")), folder)


def write_element_arrays(elements: DataFrame, folder: str) -> None:
    """As `write_json_arrays`, of elements that are JSON texts already."""
    elements.select("value").mapInArrow(_bracketed, "value string").write.text(folder)


def _bracketed(batches):
    first = True
    for batch in batches:
        texts = batch.column(0).to_pylist()
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([("[" if first and not i else ",") + t for i, t in enumerate(texts)])], names=["value"])
            first = False
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], names=["value"])


def _order_arrays(spark, sf_dir) -> str:
    folder = shared_dir(spark, "order-arrays")
    write_json_arrays(table(spark, sf_dir, "orders").select(*_ORDER_COLUMNS), folder)
    return folder


@query(_ORDERS_SQL)
def json_lines(spark, sf_dir):
    return read_json(spark, _order_lines(spark, sf_dir), _ORDERS).drop(CORRUPT)


@query(_ORDERS_SQL)
def json_multiline(spark, sf_dir):
    return read_json(spark, _order_arrays(spark, sf_dir), _ORDERS, multi_line=True).drop(CORRUPT)


@query(_ORDERS_SQL)
def json_flat_array(spark, sf_dir):
    return read_json_array(spark, _order_arrays(spark, sf_dir), _ORDERS).drop(CORRUPT)


_INFERRED_SQL = """
SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate, o_orderkey,
       o_orderpriority, o_totalprice
FROM orders
"""


@query(_INFERRED_SQL)
def json_inferred(spark, sf_dir):
    return read_json(spark, _order_lines(spark, sf_dir))


@query(_INFERRED_SQL)
def json_multiline_inferred(spark, sf_dir):
    return read_json(spark, _order_arrays(spark, sf_dir), multi_line=True)


@query(_INFERRED_SQL)
def json_split_inferred(spark, sf_dir):
    """The schema is inferred from elements that many tasks cut out of the files."""
    return read_json_array(spark, _order_arrays(spark, sf_dir), None).drop(CORRUPT)


@query("SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def parquet_roundtrip(spark, sf_dir):
    folder = shared_dir(spark, "part")
    columns = ("p_partkey", "p_name", "p_brand", "p_retailprice")
    write_parquet(table(spark, sf_dir, "part").select(*columns), folder)
    return read_parquet(spark, f"{folder}/*.parquet")
