"""Tables that change from one complete version to the next in a single step.

Every load writes a table of its own, with whatever columns and partitions it has. The name that readers use is
a view of the latest one, and altering a view is one change in the catalog: a reader sees the
old version or the new one, never a missing, empty or mixed table, also while partitioning or columns
change. Filters on partition columns pass through the view. Readers that have begun keep their version until
`remove_old_versions` drops it. Such names cannot be appended to; use `sinks.tables` for that."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.operators.quality import required

_VERSION = r"__v\d{13}_[0-9a-f]{8}"


class NotPublished(Exception):
    """The name is taken by something that is no published table."""


def publish(
    df: DataFrame,
    name: str,
    location: str,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    not_null: Sequence[str] = (),
) -> str:
    """Write a version beside `location` and let `name` show it; returns the version's table name.

    With `partition_by` the rows are range-partitioned by it and the cluster columns, as in
    `tables.load_partitioned`. A job that fails leaves the version before."""
    spark = df.sparkSession
    shown = current_version(spark, name)
    if shown is None and spark.catalog.tableExists(name):
        raise NotPublished(f"{name} is not a view that publish made; rename or drop it first")
    rows = required(df, not_null)
    writer = rows.write
    if partition_by:
        keys = [F.col(partition_by), *[F.col(c) for c in cluster_by]]
        writer = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy(partition_by)
    # the time puts versions in order, the rest keeps writers of one moment apart
    mark = f"__v{time.time_ns() // 1_000_000:013d}_{uuid.uuid4().hex[:8]}"
    version = f"{name.removesuffix('`')}{mark}{'`' * name.endswith('`')}"
    writer.option("path", f"{location.rstrip('/')}{mark}").saveAsTable(version, format="parquet", mode="error")
    # ALTER VIEW is one change; CREATE OR REPLACE would drop the view first
    spark.sql(f"{'ALTER' if shown else 'CREATE'} VIEW {name} AS SELECT * FROM {version}")
    return version


def current_version(spark: SparkSession, name: str) -> str | None:
    """The table that a published name shows; None if it is no published name."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name IN ('Type', 'View Text')").collect()
    told = {r.col_name: r.data_type for r in rows}
    found = re.fullmatch(rf"SELECT \* FROM (\S+?{_VERSION}`?)", told.get("View Text") or "")
    return found[1] if found and told.get("Type") == "VIEW" else None


def versions(spark: SparkSession, name: str) -> list[str]:
    """Version tables of a name, oldest first."""
    *database, plain = name.replace("`", "").split(".")
    listed = spark.sql(f"SHOW TABLES{' IN ' + '.'.join(f'`{d}`' for d in database) if database else ''}")
    found = [r.tableName for r in listed.collect() if re.fullmatch(re.escape(plain.lower()) + _VERSION, r.tableName)]
    return [".".join([*database, t]) for t in sorted(found)]


def remove_old_versions(spark: SparkSession, name: str, keep: int = 1) -> list[str]:
    """Drop all versions but the one that is shown and the newest `keep` others, files included; returns their names.
    Call it when no reader of an older version is left."""
    shown = (current_version(spark, name) or "").replace("`", "").lower()
    old = [v for v in versions(spark, name) if v.lower() != shown]
    gone = old[: len(old) - keep] if keep else old
    for version in gone:
        folder = spark.sql(f"DESCRIBE FORMATTED {version}").filter("col_name = 'Location'").first().data_type
        spark.sql(f"DROP TABLE {version}")
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return gone
