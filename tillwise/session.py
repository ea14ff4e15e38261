"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. AQE is the second line of defence against skew (the first is
# `operators.joins.skew_join`); UTC keeps string -> date conversions independent of the host.
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def local_session(app: str = "tillwise", cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the submitting job brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_base: str | None = None


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below `spark.checkpoint.dir`, visible to every executor.

    Only a local master may fall back to a temporary folder; on a cluster an unset folder is an
    error, because executors could not see each other's files.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        _local_base = _local_base or tempfile.mkdtemp(prefix="tillwise-")
        base = _local_base
    app = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/tillwise/{app}/{name}-{uuid.uuid4().hex[:8]}"
