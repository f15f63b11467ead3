"""File layout: health of stored tables and clustering rewrites."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_health(spark: SparkSession, locations: Mapping[str, str]) -> DataFrame:
    """Files and size per table, from the file listing alone; no row is read."""
    result = None
    for name, location in locations.items():
        files = (spark.read.format("binaryFile")
                 .option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
                 .load(location).select("path", "length"))
        line = files.agg(
            F.count("path").alias("file_count"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"),
        ).select(F.lit(name).alias("table_name"), "file_count", "size_bytes",
                 F.round(F.col("size_bytes") / 1024, 1).alias("size_kib"))
        result = line if result is None else result.unionByName(line)
    return result


def stored_health(stored: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, files and bytes per table, from the rows themselves and the files they lie in.

    Takes plain file scans; files without a row don't count.  Rows are folded per file
    before the tables meet, so what is shuffled is one line per file and task.
    """
    result = None
    for name, rows in stored.items():
        per_file = (rows.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path")
                    .agg(F.count(F.lit(1)).alias("row_count"), F.max("file_size").alias("file_size")))
        line = per_file.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("file_count"),
                            F.coalesce(F.sum("file_size"), F.lit(0)).alias("size_bytes"))
        line = line.select(F.lit(name).alias("table_name"), "*")
        result = line if result is None else result.unionByName(line)
    return result


def cluster_rows(stored: DataFrame, columns: list[str], files: int | None = None) -> DataFrame:
    """Rows of a stored Parquet table, arranged so that nearby values share a file.

    Row position and file name take part in the ranges: they are unique and the
    same on every attempt, so one heavy value, or many equal rows, spread over
    several files, and a task that is repeated yields the same rows.
    """
    placed = stored.withColumns({
        "place_in_file": F.col("_metadata.row_index"),
        "place_of_file": F.col("_metadata.file_path"),
    })
    order = [*columns, "place_in_file", "place_of_file"]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*columns).drop("place_in_file", "place_of_file")
