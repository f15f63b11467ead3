"""Audits: small aggregates that describe a batch or a table.

The counts are map-side combined, so what reaches the single final task is one
row per input task, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions import has_outer_spaces

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _columns(rows: DataFrame, kinds: tuple) -> list[str]:
    return [field.name for field in rows.schema if isinstance(field.dataType, kinds)]


def null_counts(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: how many rows lack each column."""
    return rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or rows.columns])


def whitespace_counts(rows: DataFrame) -> DataFrame:
    """One row: how many rows have outer spaces in each text column."""
    return rows.agg(*[F.count_if(has_outer_spaces(c)).alias(c) for c in _columns(rows, (T.StringType,))])


def nonpositive_counts(rows: DataFrame) -> DataFrame:
    """One row: how many rows hold a value <= 0 in each numeric column."""
    return rows.agg(*[F.count_if(F.col(c) <= 0).alias(c) for c in _columns(rows, NUMERIC)])


def batch_report(raw: DataFrame, contract: T.StructType) -> DataFrame:
    """All three audits of a raw batch in a single scan, as ``(audit, column_name, row_count)`` rows."""
    checks = []
    for field in contract:
        typed = F.trim(F.col(field.name)).try_cast(field.dataType)
        checks.append(("whitespace", field.name, F.count_if(has_outer_spaces(field.name))))
        checks.append(("null", field.name, F.count_if(typed.isNull())))
        if isinstance(field.dataType, NUMERIC):
            checks.append(("nonpositive", field.name, F.count_if(typed <= 0)))
    counted = raw.agg(F.array(*[
        F.struct(F.lit(audit).alias("audit"), F.lit(name).alias("column_name"), count.alias("row_count"))
        for audit, name, count in checks
    ]).alias("checks"))
    return counted.select(F.inline("checks"))


def nonpositive_rows(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is present and not positive."""
    return rows.where(F.col(column) <= 0)


def repeated_keys(rows: DataFrame, keys: list[str], count_name: str = "order_count") -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def versions_of(history: DataFrame, key: str, value: str) -> DataFrame:
    """Every version of one key."""
    return history.where(F.col(key) == value)


def version_counts(history: DataFrame) -> DataFrame:
    """One row: all, current, historical and closed versions."""
    return history.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_current")).alias("current_rows"),
        F.count_if(~F.col("is_current")).alias("historical_rows"),
        F.count("valid_to").alias("closed_rows"),
    )


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every named frame, one row each."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, frame in layers.items()
    ]
    result = counted[0]
    for frame in counted[1:]:
        result = result.unionByName(frame)
    return result
