"""One line per write: what was written where, when, and how many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions import moment
from orderlake.sources.tables import LakeTable

LOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("run_at", T.TimestampType()),
])


class RunLog:
    """Append-only history of table writes; the counts come with the writes themselves."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = LakeTable(spark, path, schema=LOG_SCHEMA)

    def record(self, table: str, operation: str, row_count: int, as_of: str) -> None:
        line = self.spark.range(1).select(
            F.lit(table).alias("table_name"), F.lit(operation).alias("operation"),
            F.lit(row_count).cast("long").alias("row_count"), moment(as_of).alias("run_at"))
        self.table.append(line)

    def read(self, table: str | None = None) -> DataFrame:
        log = self.table.read()
        return log if table is None else log.where(F.col("table_name") == table)
