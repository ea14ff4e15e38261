"""Catalog tables: append, truncate, replace, and the day-partitioned table.

Tables take an explicit location so that they work in any warehouse. Truncating and replacing write
a fresh folder next to that location and then point the name at it: a job that fails leaves the old
rows in place (overwriting a folder would delete them first), the query may read the table it
replaces, and open readers keep their files. `remove_old_folders` deletes what earlier loads left. A null
in a required column fails the write itself (Spark's Parquet tables accept nulls in NOT NULL columns)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.operators.quality import required


class SchemaMismatch(Exception):
    """The data does not fit the declared sink schema."""


def create_table(
    spark: SparkSession, name: str, schema: str, location: str, partition_by: str | None = None
) -> None:
    """Create an empty Parquet table if there is none."""
    partition = f"PARTITIONED BY ({partition_by})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet {partition} "
        f"LOCATION '{_quoted(location)}'"
    )


def conform(df: DataFrame, schema: str, not_null: Sequence[str] = ()) -> DataFrame:
    """The declared columns in the declared order; refuses missing, extra or differently typed ones."""
    want = T.StructType.fromDDL(schema)
    have = dict(df.dtypes)
    bad = [f.name for f in want if have.get(f.name) != f.dataType.simpleString()]
    extra = sorted(set(df.columns) - set(want.names))
    if bad or extra:
        raise SchemaMismatch(f"wrong or missing columns {bad}, unexpected columns {extra}")
    return required(df.select(*want.names), not_null)


def append_table(
    df: DataFrame, name: str, schema: str, location: str, not_null: Sequence[str] = ()
) -> None:
    """Add rows, creating the table at first use."""
    create_table(df.sparkSession, name, schema, location)
    conform(df, schema, not_null).write.mode("append").insertInto(name)


def truncate_table(
    df: DataFrame, name: str, schema: str, location: str, not_null: Sequence[str] = ()
) -> None:
    """Replace all rows by rows of the declared schema, creating the table at first use."""
    folder = _fresh_folder(location)
    conform(df, schema, not_null).write.parquet(folder)
    _point(df.sparkSession, name, schema, folder)


def replace_table(df: DataFrame, name: str, location: str) -> None:
    """Create or replace a table from a query, with whatever columns the query has."""
    folder = _fresh_folder(location)
    df.write.parquet(folder)
    _point(df.sparkSession, name, ", ".join(f"`{c}` {t}" for c, t in df.dtypes), folder)


def load_partitioned(
    df: DataFrame,
    name: str,
    schema: str,
    location: str,
    partition_by: str,
    cluster_by: Sequence[str],
    not_null: Sequence[str] = (),
) -> None:
    """Truncate and load a partitioned table whose files are sorted by the cluster columns.

    Range partitioning on (partition, cluster columns) cuts the data into even pieces: small days
    share a task, a day that holds a third of all rows is split over many, and each file covers a
    narrow range of cluster values, so Parquet statistics can skip it. `schema` must end with the
    partition column."""
    folder = _fresh_folder(location)
    keys = [F.col(partition_by), *[F.col(c) for c in cluster_by]]
    ready = conform(df, schema, not_null).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ready.write.partitionBy(partition_by).parquet(folder)
    _point(df.sparkSession, name, schema, folder, partition_by)


def remove_old_folders(spark: SparkSession, name: str, location: str, keep: int) -> list[str]:
    """Delete the folders that earlier loads of a table left beside its location, except the one the
    table shows and the newest `keep` others. Returns the deleted ones. Call it when no reader of an
    older version is left."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(location.rstrip("/"))
    store = base.getFileSystem(spark._jsc.hadoopConfiguration())
    current = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()
    shown = jvm.org.apache.hadoop.fs.Path(current.data_type) if current else None
    pattern = jvm.org.apache.hadoop.fs.Path(base.getParent(), re.sub(r"([*?{}\\[\]])", r"\\\1", base.getName()) + "-*")
    found = [s for s in store.globStatus(pattern) or [] if re.fullmatch(r"-[0-9a-f]{32}", s.getPath().getName()[len(base.getName()) :])]
    old = [s for s in found if shown is None or s.getPath().toUri().getPath() != shown.toUri().getPath()]
    old.sort(key=lambda s: s.getModificationTime(), reverse=True)
    for status in old[keep:]:
        store.delete(status.getPath(), True)
    return [s.getPath().toString() for s in old[keep:]]


def _fresh_folder(location: str) -> str:
    return f"{location.rstrip('/')}-{uuid.uuid4().hex}"


def _point(
    spark: SparkSession, name: str, schema: str, folder: str, partition_by: str | None = None
) -> None:
    """Let a table name show a folder. In one step if the table is plain before and after and keeps its
    columns. Otherwise a table with a name of its own is made ready first, partitions included, and
    then takes the name; the name never shows an empty table, and is missing only between a drop and
    a rename."""
    if partition_by is None and spark.catalog.tableExists(name):
        want = [(f.name, f.dataType.simpleString()) for f in T.StructType.fromDDL(schema)]
        have = spark.catalog.listColumns(name)
        if spark.table(name).dtypes == want and not any(c.isPartition for c in have):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(folder)}'")
            return
    ready = f"{name.removesuffix('`')}_{uuid.uuid4().hex[:12]}{'`' * name.endswith('`')}"
    create_table(spark, ready, schema, folder, partition_by)
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {ready}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {ready} RENAME TO {name}")


def _quoted(path: str) -> str:
    return path.replace("'", "\\'")
