"""How unevenly the rows of a table spread over the values of each column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.contracts import SKEW_HIGH, SKEW_LOW


def value_counts(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column_name, value, row_count)`` for every column, from a single scan; NULL is a value."""
    columns = columns or rows.columns
    as_text = rows.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (as_text.unpivot([], columns, "column_name", "value")
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count")))


def skew_stats(counts: DataFrame) -> DataFrame:
    """Per column: heaviest, mean and lightest key, number of keys, ratio and flag."""
    stats = counts.groupBy("column_name").agg(
        F.max("row_count").alias("max_count"),
        F.sum("row_count").alias("total_rows"),
        F.min("row_count").alias("min_count"),
        F.count(F.lit(1)).alias("distinct_keys"))
    mean = F.col("total_rows").cast("double") / F.col("distinct_keys")
    flag = (F.when(F.col("skew_ratio") > SKEW_HIGH, "HIGH")
            .when(F.col("skew_ratio") < SKEW_LOW, "OK").otherwise("MODERATE"))
    return (stats.withColumn("avg_count", mean)
            .withColumn("skew_ratio", F.when(F.col("avg_count") > 0, F.col("max_count") / F.col("avg_count"))
                        .otherwise(F.lit(0.0)))
            .withColumn("skew_flag", flag)
            .select("column_name", "max_count", "avg_count", "min_count", "distinct_keys",
                    "skew_ratio", "skew_flag"))


def heaviest_keys(counts: DataFrame, top_n: int = 10, slices: int = 256) -> DataFrame:
    """The ``top_n`` heaviest keys of each column, ties in value order.

    Ranked in two steps, first inside hash slices of the values and then among
    the slice winners, so a column with billions of keys never meets in one task.
    """
    heaviest_first = [F.col("row_count").desc(), F.col("value").asc_nulls_first()]
    in_slice = Window.partitionBy("column_name", "slice").orderBy(*heaviest_first)
    in_column = Window.partitionBy("column_name").orderBy(*heaviest_first)
    winners = (counts.withColumn("slice", F.pmod(F.xxhash64("value"), F.lit(slices)))
               .withColumn("slice_rank", F.row_number().over(in_slice))
               .where(F.col("slice_rank") <= top_n)
               .drop("slice", "slice_rank"))
    return (winners.withColumn("key_rank", F.row_number().over(in_column))
            .where(F.col("key_rank") <= top_n)
            .select("column_name", "key_rank", "value", "row_count"))
