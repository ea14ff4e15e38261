"""Registration of a query together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        _SQL[fn.__name__] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_table(spark: SparkSession, name: str) -> str:
    """A table name of this application, dropped if an earlier run made it."""
    app = spark.sparkContext.applicationId.replace("-", "_")
    full = f"tillwise_{name}_{app}"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    return full
