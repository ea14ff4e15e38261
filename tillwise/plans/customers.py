"""Customer load: an all-text CSV by position -> typed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.dates import warehouse_datetime
from tillwise.sinks.tables import replace_table, truncate_table
from tillwise.sources.files import read_csv
from tillwise.sources.schemas import CUSTOMER_RAW

# The timestamp columns in output order.
STAMPS = ("start", "end", "create", "last_update")


def typed_customers(raw: DataFrame, as_date: bool = True) -> DataFrame:
    """Type the four timestamp texts twice: `*_ts` as DATE (or datetime), `*_timestamp` as datetime.

    Each text is parsed once, in a stage below the select, under a name of its own, because `*_ts` is
    both a source and an output name. A text in another layout fails the job."""
    staged = raw.select("*", F.explode(F.array(F.struct(*[warehouse_datetime(f"{s}_ts").alias(s) for s in STAMPS]))).alias("_parsed"))
    parsed = {s: F.col("_parsed")[s] for s in STAMPS}

    def day(stamp: str):
        return (parsed[stamp].cast("date") if as_date else parsed[stamp]).alias(f"{stamp}_ts")

    return staged.select(
        "customer_nbr",
        "customer_desc",
        day("start"),
        day("end"),
        day("create"),
        "create_user_id",
        day("last_update"),
        "last_update_user_id",
        *[parsed[s].alias(f"{s}_timestamp") for s in STAMPS],
        F.col("client_id"),
    )


def load_customers(
    spark: SparkSession, path: str, raw_table: str, typed_table: str, location: str
) -> None:
    """Truncate and load the raw table, then replace the typed table from it."""
    raw = read_csv(spark, path, CUSTOMER_RAW)
    truncate_table(raw, raw_table, CUSTOMER_RAW, f"{location}/raw")
    replace_table(typed_customers(spark.table(raw_table)), typed_table, f"{location}/typed")
