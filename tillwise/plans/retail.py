"""Retail sales: transactions -> clean -> line totals -> sums per store, category and day."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.dates import iso_date
from tillwise.functions.numbers import exact_sum
from tillwise.operators.cleaning import drop_incomplete
from tillwise.operators.quality import EmptyInput, observe_counts, require_rows, split_required
from tillwise.session import shared_dir
from tillwise.sinks.files import check_output, write_parquet
from tillwise.sinks.tables import load_partitioned
from tillwise.sources.files import CORRUPT, is_corrupt, read_json, read_json_array, read_parquet
from tillwise.sources.schemas import (
    DAILY_SALES,
    DAILY_SALES_REQUIRED,
    TRANSACTION_KEYS,
    TRANSACTIONS,
)

DAILY_KEYS = ("store_id", "category_id", "transaction_date")


def read_transactions(
    spark: SparkSession, path: str, layout: str = "lines", schema: str | None = TRANSACTIONS
) -> DataFrame:
    """`lines`: one object per line; `array`: one array per file; `flat_array`: the same for large
    files, split over many tasks. `schema=None` infers."""
    if layout == "flat_array":
        return read_json_array(spark, path, schema or TRANSACTIONS)
    if layout not in ("lines", "array"):
        raise ValueError(f"unknown layout: {layout}")
    return read_json(spark, path, schema, multi_line=layout == "array")


def with_totals(transactions: DataFrame) -> DataFrame:
    """Add `total_price` and `transaction_date` (null where the timestamp cannot be read)."""
    return transactions.withColumns(
        {"total_price": F.col("quantity") * F.col("price"), "transaction_date": iso_date("timestamp")}
    )


def sales_by(
    rows: DataFrame,
    keys: Sequence[str] = DAILY_KEYS,
    measure: str | Column = "total_price",
    name: str = "total_sales",
    scale: int | None = None,
) -> DataFrame:
    """Sum a measure per group. `scale` = number of decimals of the money column makes the sum exact
    and independent of row order; without it the sum is a plain double sum. Null dates group too."""
    measure = F.col(measure) if isinstance(measure, str) else measure
    total = F.sum(measure) if scale is None else exact_sum(measure, scale)
    return rows.groupBy(*keys).agg(total.alias(name))


def daily_sales(
    transactions: DataFrame,
    complete: Sequence[str] | None = TRANSACTION_KEYS,
    scale: int | None = None,
) -> DataFrame:
    """The whole chain: drop incomplete rows (`complete=None`: a null anywhere), total, date, sum."""
    return sales_by(with_totals(drop_incomplete(transactions.drop(CORRUPT), complete)), scale=scale)


def amount_sales(transactions: DataFrame, scale: int | None = None) -> DataFrame:
    """The same for transactions that carry an `amount` instead of quantity and price."""
    complete = drop_incomplete(transactions.drop(CORRUPT))
    dated = complete.withColumn("transaction_date", iso_date("timestamp"))
    return sales_by(dated, measure="amount", scale=scale)


@dataclass(frozen=True)
class SalesReport:
    """What a run read, dropped and wrote; `status` is `written` or `no data`."""

    status: str
    read: int = 0
    corrupt: int = 0
    kept: int = 0
    undated: int = 0
    groups: int = 0


def run_daily_sales(
    spark: SparkSession,
    source: str,
    output: str,
    layout: str = "lines",
    complete: Sequence[str] | None = TRANSACTION_KEYS,
    schema: str | None = TRANSACTIONS,
) -> SalesReport:
    """Read, aggregate and write one Parquet folder in a single job, counting rows on the way."""
    check_output(output, [source])
    raw = read_transactions(spark, source, layout, schema)
    if raw.columns == [CORRUPT]:
        return SalesReport("no data")
    try:
        require_rows(raw.drop(CORRUPT), source)
    except EmptyInput:
        return SalesReport("no data")
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    seen, kept, out = Observation("read"), Observation("kept"), Observation("groups")
    counted = observe_counts(raw, seen, corrupt=F.count_if(is_corrupt())).drop(CORRUPT)
    priced = observe_counts(
        with_totals(drop_incomplete(counted, complete)),
        kept,
        undated=F.count_if(F.col("transaction_date").isNull()),
    )
    write_parquet(observe_counts(sales_by(priced), out), output, inputs=[source])
    if read_parquet(spark, output).isEmpty():
        # Spark drops the counting steps from a plan that turns out to be empty, so count again. The
        # hash makes the reader parse all fields, without which it does not judge the record.
        total = raw.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(is_corrupt()).alias("corrupt"),
            F.max(F.hash(*raw.columns)).alias("parsed"),
        ).first()
        return SalesReport("written", total["rows"], total["corrupt"])
    return SalesReport(
        "written", seen.get["rows"], seen.get["corrupt"], kept.get["rows"], kept.get["undated"],
        out.get["rows"],
    )


def load_daily_table(
    sales: DataFrame, name: str, location: str, quarantine: str | None = None
) -> None:
    """Load daily sales into the day-partitioned table; rows without a store, category or day go to
    the `quarantine` folder (without one, such a row fails the load). With a quarantine the sums are
    first written to a shared folder, since they are read once for either target."""
    if quarantine is not None:
        stage = shared_dir(sales.sparkSession, "daily-sales")
        write_parquet(sales, stage)
        sales = read_parquet(sales.sparkSession, stage)
    _load(sales, name, location, quarantine)


def load_daily_folder(
    spark: SparkSession, folder: str, name: str, location: str, quarantine: str | None = None
) -> None:
    """As `load_daily_table`, from the Parquet folder or wildcard that `run_daily_sales` wrote."""
    _load(read_parquet(spark, folder), name, location, quarantine)


def _load(sales: DataFrame, name: str, location: str, quarantine: str | None) -> None:
    if quarantine is not None:
        sales, bad = split_required(sales, DAILY_SALES_REQUIRED)
        write_parquet(bad, quarantine)
    load_partitioned(
        sales, name, DAILY_SALES, location, "transaction_date", ("store_id", "category_id"),
        DAILY_SALES_REQUIRED,
    )
