"""Comparison of the history with a manifest of expected outcomes, all on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.contracts import PROGRESSED, UNCHANGED
from orderlake.operators.merge import closed_versions


def _closed_ids(history: DataFrame, key: str) -> DataFrame:
    return closed_versions(history).select(key).distinct()


def _listed(manifest: DataFrame, key: str, category: str) -> DataFrame:
    return manifest.where(F.col("expected_category") == category).select(key).distinct()


def missing_history(history: DataFrame, manifest: DataFrame, key: str = "order_id") -> DataFrame:
    """Listed as progressed, yet without a closed version."""
    return _listed(manifest, key, PROGRESSED).join(_closed_ids(history, key), key, "left_anti")


def unexpected_history(history: DataFrame, manifest: DataFrame, key: str = "order_id") -> DataFrame:
    """With a closed version, yet not listed as progressed."""
    return _closed_ids(history, key).join(_listed(manifest, key, PROGRESSED), key, "left_anti")


def wrong_history(history: DataFrame, manifest: DataFrame, key: str = "order_id") -> DataFrame:
    """With a closed version, yet listed as unchanged."""
    return _closed_ids(history, key).join(_listed(manifest, key, UNCHANGED), key, "left_semi")


def reconciliation(history: DataFrame, manifest: DataFrame, key: str = "order_id") -> DataFrame:
    """One row: sizes of both id sets, of their differences, and whether they agree."""
    closed = _closed_ids(history, key).withColumn("is_closed", F.lit(True))
    listed = _listed(manifest, key, PROGRESSED).withColumn("is_listed", F.lit(True))
    sides = closed.join(listed, key, "full")
    return sides.agg(
        F.count("is_closed").alias("closed_ids"),
        F.count("is_listed").alias("listed_ids"),
        F.count_if(F.col("is_closed").isNull()).alias("missing_ids"),
        F.count_if(F.col("is_listed").isNull()).alias("unexpected_ids"),
    ).withColumn("is_match", (F.col("missing_ids") == 0) & (F.col("unexpected_ids") == 0))


def version_mismatches(log: DataFrame, key: str = "order_id", versions: int = 2) -> DataFrame:
    """Keys of the change log that do not have exactly ``versions`` rows."""
    return (log.groupBy(key).agg(F.count(F.lit(1)).alias("version_count"))
            .where(F.col("version_count") != versions))
