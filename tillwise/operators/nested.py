"""Flattening of users -> sessions -> page views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_sessions(users: DataFrame, keep_empty: bool = True) -> DataFrame:
    """One row per page view. `keep_empty` keeps users without sessions and sessions without views
    as rows of nulls. Row-local: no shuffle."""
    explode = F.explode_outer if keep_empty else F.explode
    sessions = users.select(
        "user_id",
        "name",
        F.col("location.city").alias("city"),
        F.col("location.country").alias("country"),
        explode("sessions").alias("s"),
    )
    views = sessions.select(
        "user_id",
        "name",
        "city",
        "country",
        F.col("s.session_id").alias("session_id"),
        F.col("s.start_time").alias("start_time"),
        explode("s.page_views").alias("v"),
    )
    return views.select(
        "user_id", "name", "city", "country", "session_id", "start_time",
        F.col("v.page").alias("page"), F.col("v.duration").alias("duration"),
    )
