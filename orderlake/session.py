"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def lake_session(app: str = "orderlake", master: str | None = None, **settings: str) -> SparkSession:
    """A session in one time zone; adaptive execution is on by default, cluster sizes stay with the caller.

    ``settings`` take underscores for dots, e.g. ``spark_sql_shuffle_partitions="4000"``.
    """
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.session.timeZone", "UTC"))
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
