"""Small append-only tables in which a lake notes what its batches brought.

Every entry is written before the change it announces, so that a run that dies
in between is completed by running it again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions import moment
from orderlake.sources.tables import LakeTable

#: Entry of a batch whose reports are complete.
REPORTED = "reported"


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()]
                        + [T.StructField("batch", T.TimestampType())])


class PartitionLedger:
    """Which partitions of a table a batch wrote to; its entries are as many as the folders touched."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = LakeTable(spark, path, schema=_schema(table_name=T.StringType(), partition_value=T.StringType()))

    def note(self, table: str, values: list, as_of: str) -> None:
        if values:
            texts = F.array(*[F.lit(None if v is None else str(v)).cast("string") for v in values])
            self.table.append(self.spark.range(1).select(
                F.lit(table).alias("table_name"), F.explode(texts).alias("partition_value"), moment(as_of).alias("batch")))

    def _values(self, entries: DataFrame, kind: T.DataType) -> list:
        texts = [row[0] for row in entries.select("partition_value").distinct().collect()]
        return [dt.date.fromisoformat(v) if v is not None and isinstance(kind, T.DateType) else v for v in texts]

    def of_batch(self, table: str, as_of: str, kind: T.DataType) -> list:
        """Partitions that earlier runs of this batch wrote to."""
        if not self.table.exists():
            return []
        mine = (F.col("table_name") == table) & (F.col("batch") == moment(as_of))
        return self._values(self.table.read().where(mine), kind)

    def unreported(self, table: str, as_of: str, kind: T.DataType) -> list:
        """Partitions written by this batch, or by others whose reports were never completed."""
        if not self.table.exists():
            return []
        entries = self.table.read()
        done = entries.where((F.col("table_name") == REPORTED) & (F.col("batch") != moment(as_of)))
        return self._values(entries.where(F.col("table_name") == table)
                            .join(done.select("batch").distinct(), "batch", "left_anti"), kind)


class FileLedger:
    """The files that were landed, from the file listing: address, size and time of change."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = LakeTable(spark, path, schema=_schema(
            file_path=T.StringType(), file_size=T.LongType(), changed_at=T.TimestampType()))

    def listed(self, files: list[str], as_of: str) -> DataFrame:
        """One row per file; no content is read."""
        return self.spark.read.format("binaryFile").load(files).select(
            F.regexp_replace("path", "^file:/+", "file:/").alias("file_path"), F.col("length").alias("file_size"),
            F.col("modificationTime").alias("changed_at"),
            moment(as_of).alias("batch"))

    def note(self, files: list[str], as_of: str) -> None:
        self.table.append(self.listed(files, as_of).coalesce(1))

    def knows_any(self, files: list[str]) -> bool:
        if not self.table.exists():
            return False
        names = self.spark.createDataFrame([(f,) for f in files], "file_path string")
        return not self.table.read().join(names, "file_path", "left_semi").isEmpty()


class ColumnLedger:
    """Columns beyond the contract, in the order in which deliveries brought them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = LakeTable(spark, path, schema=_schema(place=T.IntegerType(), column_name=T.StringType()))

    def read(self) -> list[str]:
        if not self.table.exists():
            return []
        return [row[0] for row in self.table.read().orderBy("place").select("column_name").collect()]

    def note(self, first: int, names: list[str], as_of: str) -> None:
        self.table.append(self.spark.range(1).select(
            F.posexplode(F.array(*[F.lit(n) for n in names])).alias("place", "column_name"), moment(as_of).alias("batch"))
            .withColumn("place", F.col("place") + first))


class LayerLog:
    """How many rows of a batch each layer took, counted by the writes that made them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = LakeTable(spark, path, schema=_schema(layer=T.StringType(), row_count=T.LongType()))

    def note(self, counts: list[tuple[str, int, str]]) -> None:
        if counts:
            self.table.append(self.spark.range(1).select(F.inline(F.array(*[F.struct(
                F.lit(layer).alias("layer"), F.lit(rows).cast("long").alias("row_count"), moment(as_of).alias("batch"))
                for layer, rows, as_of in counts]))))

    def read(self) -> DataFrame:
        return self.table.read()


class StageLog:
    """When the stages of each run began and ended."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = LakeTable(spark, path, schema=_schema(
            stage=T.StringType(), started_at=T.TimestampType(), ended_at=T.TimestampType(), seconds=T.DoubleType()))

    def note(self, times: list[tuple[str, dt.datetime, dt.datetime, str]]) -> None:
        if times:
            self.table.append(self.spark.range(1).select(F.inline(F.array(*[F.struct(
                F.lit(stage).alias("stage"), F.lit(started).alias("started_at"), F.lit(ended).alias("ended_at"),
                F.lit((ended - started).total_seconds()).alias("seconds"), moment(as_of).alias("batch"))
                for stage, started, ended, as_of in times]))))

    def read(self) -> DataFrame:
        return self.table.read()
