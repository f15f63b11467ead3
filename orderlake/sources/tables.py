"""Parquet tables on a shared file system.

A table is a folder of ``snapshot=N`` folders.  A snapshot counts once Spark has
put its ``_SUCCESS`` marker there, and readers take the newest one that counts,
so a rewrite never touches the files it reads and one that dies halfway leaves the
table as it was.  Batches that only add rows are appended to the newest snapshot;
batches that only concern some partitions replace just those.  These two change
the newest snapshot in place: a job that dies while it commits is to be run again.
One writer per table at a time is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.operators.layout import cluster_rows


#: Of all files written.  The codec makes them about a quarter smaller than Spark's own choice.  A column whose distinct
#: values outgrow a dictionary of 64 kB (Spark's own choice: 1 MB) is written plain from there on: keys and prices outgrow
#: either, and the larger one is built and looked up for most of a file before it is given up.
FILES = {"compression": "zstd", "parquet.dictionary.page.size": str(64 * 1024)}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local["):
        import tempfile

        folder = tempfile.mkdtemp(prefix="orderlake-")
        spark.sparkContext.setCheckpointDir(folder)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


class Stage:
    """Intermediate results of one run, written to the shared folder.

    A small result written here has a known size, so the planner may broadcast
    it without first shuffling the large side; a large one is joined by shuffle.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/orderlake-{uuid.uuid4().hex}"

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        rows.write.mode("overwrite").options(**FILES).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def clear(self) -> None:
        """Delete everything kept so far; frames read from it can no longer be run."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class LakeTable:
    """A named Parquet table with optional partition columns and in-file order."""

    def __init__(self, spark: SparkSession, path: str, partition_by: tuple[str, ...] = (),
                 cluster_by: tuple[str, ...] = (), schema: T.StructType | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = tuple(partition_by)
        self.cluster_by = tuple(cluster_by)
        self.schema = schema

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]

    # --- snapshots ---------------------------------------------------------

    def _snapshots(self) -> list[int]:
        """Numbers of the complete snapshots, ascending."""
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}/snapshot=*/_SUCCESS")
        files = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = files.globStatus(pattern) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def _folder(self, snapshot: int) -> str:
        return f"{self.path}/snapshot={snapshot:08d}"

    def exists(self) -> bool:
        return bool(self._snapshots())

    def location(self) -> str:
        """Folder of the newest complete snapshot."""
        snapshots = self._snapshots()
        if not snapshots:
            raise FileNotFoundError(f"no complete snapshot under {self.path}")
        return self._folder(snapshots[-1])

    # --- reading and writing -----------------------------------------------

    def read(self, evolved: bool = False) -> DataFrame:
        """The newest snapshot.

        With a ``schema`` no file is opened to find the columns and partition
        values keep their declared type.  ``evolved`` instead merges the schemas
        of all files, for tables whose later batches brought new columns.
        """
        reader = self.spark.read
        if evolved:
            reader = reader.option("mergeSchema", True)
        elif self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.parquet(self.location())

    def _write(self, rows: DataFrame, folder: str, mode: str, dynamic: bool = False, as_read: bool = False) -> int:
        counter = Observation()
        arranged = (rows if as_read else self._arranged(rows)).observe(counter, F.count(F.lit(1)).alias("rows"))
        writer = arranged.write.mode(mode).options(**FILES)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(folder)
        return counter.get["rows"]

    def _arranged(self, rows: DataFrame) -> DataFrame:
        """Rows laid out for few, ordered files.

        Ranges over partition and cluster columns give files with narrow value
        ranges.  ``cluster_by`` should end in a column that tells the rows of a
        heavy value apart; a range boundary can then fall inside that value.
        """
        if not self.cluster_by:
            # one folder's rows go to few tasks, however many there are; large folders are split
            return rows.hint("rebalance", *self.partition_by) if self.partition_by else rows
        order = [*self.partition_by, *self.cluster_by]
        return rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def publish(self, rows: DataFrame, as_read: bool = False) -> int:
        """Write ``rows`` as the new content; returns how many were written.

        ``as_read`` leaves them in the tasks they come from, each of which then
        opens a file per partition value it has.
        """
        snapshots = self._snapshots()
        following = snapshots[-1] + 1 if snapshots else 1
        return self._write(rows, self._folder(following), "overwrite", as_read=as_read)

    def append(self, rows: DataFrame, as_read: bool = False) -> int:
        """Add ``rows`` to the newest snapshot, or start the first one."""
        if not self.exists():
            return self.publish(rows, as_read)
        return self._write(rows, self.location(), "append", as_read=as_read)

    def optimize(self, columns: tuple[str, ...] = ()) -> int:
        """Rewrite the table as a new snapshot with nearby values in the same files."""
        order = [*self.partition_by, *(columns or self.cluster_by)]
        plain = LakeTable(self.spark, self.path, self.partition_by, schema=self.schema)
        return plain.publish(cluster_rows(self.read(), order))

    def replace_partitions(self, rows: DataFrame, as_read: bool = False) -> int:
        """Replace only the partitions that ``rows`` has rows for.

        Spark writes aside first and swaps the partitions at commit, so ``rows``
        may be computed from this very table.
        """
        return self._write(rows, self.location(), "overwrite", dynamic=True, as_read=as_read)

    def drop_partitions(self, values: list) -> None:
        """Delete the folders of these values of the first partition column from the newest snapshot."""
        column, jvm = self.partition_by[0], self.spark.sparkContext._jvm
        named = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        for value in values:
            folder = jvm.org.apache.hadoop.fs.Path(
                f"{self.location()}/{named(column, None if value is None else str(value))}")
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
