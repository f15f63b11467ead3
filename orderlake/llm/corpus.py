"""Helpers that the corpus operators share: tables, staging, words and sampling."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderlake.sources.tables import shared_folder

MASK = 0xFFFFFFFFFFFFFFFF
#: Ids up to this number may be broadcast (8 MB of longs); more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Rows whose texts are Python objects at the same time.
SLICE = 500
#: Words that a memory of a Python worker holds, none longer than ``WORD``: below 50 MB with what is known of them.
#: Further ones are worked out each time they occur.
REMEMBERED, WORD = 150_000, 64
#: The same for operators whose new words cost most; such a memory ends when its worker serves another operator.
LONG_REMEMBERED = 600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Shelf:
    """Intermediate tables of one run in the folder that all executors share.

    Reading a kept table does not run its plan again, so lost executors cost a
    file scan and no recomputation.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete one kept table that nothing reads any more."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def crc_class(name: str, modulus: int) -> Column:
    """crc32 of a column's text form modulo a number; NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % modulus


def share_of(name: str, share: float, salt: int = 0) -> Column:
    """True for about this share of the ids, always for the same ones."""
    spread = F.pmod(F.xxhash64(F.col(name), F.lit(salt)), F.lit(1 << 30))
    return spread < F.lit(int(share * (1 << 30)))


def join_small(rows: DataFrame, ids: DataFrame, key: str, how: str, count: int) -> DataFrame:
    """Join with a kept table of known row count; it is broadcast only while that count is small."""
    return rows.join(F.broadcast(ids) if count <= BROADCAST_ROWS else ids, key, how)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int,
                    most: int) -> DataFrame:
    """``doc_id, text, label`` for about ``most`` labelled rows outside the held-out class.

    Labels of one document are merged to the larger one, NULL labels are left
    out.  The sample is chosen by a hash of the id, so its expected size is the
    bound whatever the table's size; only these ids are broadcast, never texts.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                          & (crc_class("doc_id", modulus) != held_out))
             .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")))
    total = known.count()
    if total > most:
        known = known.where(share_of("doc_id", most / total))
    chosen = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return chosen.join(F.broadcast(known), "doc_id")


_MEMORIES: dict[str, dict] = {}


def lasting_memory(name: str, memory: dict) -> None:
    """Let a worker keep a memory from task to task of the operator ``name``."""
    _MEMORIES[name] = memory


def free_memories(but: str = "") -> None:
    """Clear the lasting memories of other operators in this worker; called by their tasks at the start."""
    for name, memory in _MEMORIES.items():
        if name != but:
            memory.clear()


class WordHashes(dict):
    """64-bit hash of a word given as bytes; frequent words are hashed once per task."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED and len(word) <= WORD:
            self[word] = value
        return value


_HASHES = WordHashes()


def words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z in lower case, as UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed invertible mixing of 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; a shorter text is one run; none without words."""
    if len(hashes) == 0:
        return hashes
    size = min(size, len(hashes))
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x100000001B3) + hashes[k:len(hashes) - size + 1 + k]
    return mixed(total + np.uint64(size))


def signed(values: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return values.view(np.int64)


def per_text(rows: DataFrame, text: str, make: Callable[[], Callable[[list], list[pa.Array]]],
             added: str, keep_text: bool = False, memory: str = "") -> DataFrame:
    """Add columns worked out from the values of one column, a slice of rows at a time.

    ``make`` runs once per task and returns the function from a list of values to
    the added columns (``added`` is their DDL).  All other columns pass through
    as Arrow arrays, so NULL ids stay exact; the text itself only if asked for.
    ``memory`` names the lasting memory that ``make`` uses.
    """
    kept = [c for c in rows.columns if c != text or keep_text]
    read = kept if keep_text else [*kept, text]
    fields = [rows.schema[c] for c in kept] + T._parse_datatype_string(added).fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memories(memory)
        work = make()
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE):
                    part = batch.slice(start, SLICE)
                    arrays = [part.column(read.index(c)) for c in kept]
                    arrays += work(part.column(read.index(text)).to_pylist())
                    yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])
        finally:  # workers are used again by other stages
            _HASHES.clear()

    return rows.select(*read).mapInArrow(run, T.StructType(fields))


def per_partition(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], dict[str, list]],
                  schema: str) -> DataFrame:
    """A few result rows, given as lists of columns, from all batches of a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memories()
        yield pa.RecordBatch.from_pydict(work(batches), schema=to_arrow_schema(fields))

    fields = T._parse_datatype_string(schema)
    return rows.mapInArrow(run, fields)


def folded_blocks(rows: DataFrame, add: Callable[[int, np.ndarray | None, bytes], np.ndarray]) -> DataFrame:
    """Fold the binary ``value`` of each ``block``, in the order of the tasks that brought them.

    The rows of a block are streamed: whatever their number, a worker holds one running result beside one
    Arrow batch, whose bytes Spark bounds.
    """
    schema = pa.schema([("block", pa.int32()), ("value", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"block": [at], "value": [out.tobytes()]}, schema=schema)

        at, out = None, None
        for batch in batches:
            for block, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != at and out is not None:
                    yield result()
                    out = None
                at, out = block, add(block, out, value.as_py())
        if out is not None:
            yield result()

    ordered = (rows.select("block", "value", F.spark_partition_id().alias("task"))
               .repartition("block").sortWithinPartitions("block", "task"))
    return ordered.select("block", "value").mapInArrow(run, "block int, value binary")


def summed_blocks(rows: DataFrame, kind: str) -> DataFrame:
    """Sum binary number vectors by ``block``: partial sums of partitions become totals."""
    def add(_: int, out: np.ndarray | None, value: bytes) -> np.ndarray:
        numbers = np.frombuffer(value, kind)
        return numbers.copy() if out is None else np.add(out, numbers, out=out)

    return folded_blocks(rows, add)


def fresh(rows: DataFrame, name: str) -> str:
    """A column name that the rows don't have."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name
