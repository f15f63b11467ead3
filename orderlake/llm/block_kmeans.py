"""Centroid clustering: Lloyd's rounds over column blocks, in whole numbers.

Every component becomes ``floor(256 * x)``.  Vectors are laid out in chunks of rows, and each chunk
in blocks of columns.  A block task works out its columns' exact share of every squared distance against the
centroid slice of its columns; ``reduceByKey`` adds the shares of a chunk's blocks, and the smallest sum
is the assignment.  Assignments travel to the blocks (the columns stay where they are), where each block
sums its own slice; a slice of the next centroids is the floor of its sums over the counts.  Only centroids
(clusters x components numbers) pass through the driver, whatever the number of rows.

Kept are vectors with exactly ``length`` components, none NULL or non-finite; others have no row in the
result, an empty table gives an empty one.  Repeated rows and ids are rows of their own.  Rows with a NULL id are
clustered but never start a centroid.  Scaled components beyond +-2^27 count as that bound, so that every
distance fits a long; a sum of distances beyond a long is NULL.  Of equal start hashes the smaller vector comes first; with fewer rows than clusters there
are as many centroids as rows.  Other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.rdd import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.corpus import Shelf

SCALE = 256
CLUSTERS, ROUNDS, LENGTH = 40, 5, 64
#: Columns of one block.
BLOCK = 16
#: Rows of one chunk: a block's distances for a chunk stay below a megabyte.
CHUNK = 2048
BOUND = 1 << 27


def whole(name: str) -> Column:
    """The vector in whole numbers, held within the bound."""
    def cell(x: Column) -> Column:
        held = F.greatest(F.lit(float(-BOUND)), F.least(F.lit(float(BOUND)), x.cast("double") * SCALE))
        return F.floor(held).cast("int")

    return F.transform(name, cell)


def kept_vectors(rows: DataFrame, key: str, vector: str, length: int) -> DataFrame:
    """``id, cells`` of the vectors that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (rows.where(F.coalesce((F.size(vector) == length) & finite, F.lit(False)))
            .select(F.col(key).cast("long").alias("id"), whole(vector).alias("cells")))


def starts(vectors: DataFrame, clusters: int, salt: str) -> np.ndarray:
    """The vectors with the smallest hashes of ``salt`` and id; a bounded number of rows."""
    drawn = (vectors.where(F.col("id").isNotNull())
             .select(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).alias("hash"), "cells")
             .orderBy("hash", "cells").limit(clusters).collect())
    return np.array([r.cells for r in drawn], np.int64)


def chunked(vectors: DataFrame, length: int, block: int = BLOCK, rows: int = CHUNK) -> DataFrame:
    """Chunks of rows in blocks of columns; the ids go with the first block."""
    schema = T._parse_datatype_string("chunk bigint, block int, n int, ids array<bigint>, cells binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the task's number in the low bits deals the chunks evenly to the partitions of a keyed collection
        number = TaskContext.get().partitionId()
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                part = batch.slice(first, rows)
                cells = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(-1, length)
                for k, column in enumerate(range(0, length, block)):
                    yield pa.RecordBatch.from_pydict({
                        "chunk": [number], "block": [k], "n": [part.num_rows],
                        "ids": [part.column(0).to_pylist() if k == 0 else None],
                        "cells": [np.ascontiguousarray(cells[:, column:column + block]).tobytes()],
                    }, schema=pa.schema([("chunk", pa.int64()), ("block", pa.int32()), ("n", pa.int32()),
                                         ("ids", pa.list_(pa.int64())), ("cells", pa.binary())]))
                number += 1 << 24

    return vectors.mapInArrow(run, schema)


def shares(cells: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances over some columns, rows x centroids.

    The product runs in doubles only where every sum in it stays below 2^53.
    """
    x, c = cells.astype(np.int64), centroids.astype(np.int64)
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    small = most * most * x.shape[1] < 1 << 53
    product = (x.astype(float) @ c.T.astype(float)).astype(np.int64) if small else x @ c.T
    return (x * x).sum(1)[:, None] - 2 * product + (c * c).sum(1)[None, :]


class Blocks:
    """The chunked cells as a keyed collection that stays where it is over all rounds."""

    def __init__(self, table: DataFrame, length: int, block: int):
        self.block, self.numbers = block, range(-(-length // block))
        rows = table.select("chunk", "block", "n", "cells").rdd
        self.tasks = max(1, rows.getNumPartitions())
        self.cells = rows.map(lambda r: ((r.chunk, r.block), np.frombuffer(r.cells, "<i4").reshape(r.n, -1))) \
            .partitionBy(self.tasks)

    def nearest(self, centroids: np.ndarray) -> RDD:
        """Per chunk the nearest centroid of each row (the smaller number of equal ones) and its distance."""
        width = self.block
        partial = self.cells.map(lambda kv: (kv[0][0], shares(
            kv[1], centroids[:, kv[0][1] * width:(kv[0][1] + 1) * width])))

        def pick(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = sums.argmin(1)
            return at.astype(np.int32), sums[np.arange(len(sums)), at]

        return partial.reduceByKey(np.add, self.tasks).mapValues(pick)

    def moved(self, assigned: RDD, centroids: np.ndarray) -> np.ndarray:
        """The next centroids; every block sums and divides its own slice."""
        numbers, k, width = self.numbers, len(centroids), self.block
        there = assigned.flatMap(lambda kv: [((kv[0], b), kv[1][0]) for b in numbers]).partitionBy(self.tasks)

        def slice_sums(item):
            (_, number), (cells, at) = item
            order = np.argsort(at, kind="stable")
            present, first = np.unique(at[order], return_index=True)
            sums, counts = np.zeros((k, cells.shape[1]), np.int64), np.zeros(k, np.int64)
            sums[present] = np.add.reduceat(cells[order].astype(np.int64), first, axis=0)
            counts[present] = np.diff(np.append(first, len(at)))
            return number, (sums, counts)

        def updated(item):
            number, (sums, counts) = item
            old = centroids[:, number * width:(number + 1) * width]
            return number, np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], old)

        totals = (self.cells.join(there, self.tasks).map(slice_sums)
                  .reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), min(self.tasks, len(numbers)))
                  .map(updated).collect())
        return np.hstack([part for _, part in sorted(totals, key=lambda t: t[0])])


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clustered(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS,
              rounds: int = ROUNDS, length: int = LENGTH, salt: str = "2:", block: int = BLOCK,
              chunk: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """Per kept vector ``key, cluster, distance``, and the final centroids."""
    spark, shelf = rows.sparkSession, Shelf(rows.sparkSession, "kmeans")
    vectors = kept_vectors(rows, key, vector, length)
    centroids = starts(vectors, clusters, salt)
    if not len(centroids):
        return spark.createDataFrame([], f"{key} bigint, cluster int, distance bigint"), centroids
    table = shelf.keep(chunked(vectors, length, block, chunk), "chunks")
    blocks = Blocks(table, length, block)
    for _ in range(rounds):
        centroids = blocks.moved(blocks.nearest(centroids), centroids)
    last = shelf.keep(spark.createDataFrame(
        blocks.nearest(centroids).map(lambda kv: (kv[0], bytearray(kv[1][0].tobytes()), bytearray(kv[1][1].tobytes()))),
        "chunk bigint, at binary, apart binary"), "assigned")
    named = table.where("block = 0").select("chunk", "ids").join(last, "chunk")
    schema = T._parse_datatype_string(f"{key} bigint, cluster int, distance bigint")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, at, apart in zip(*(batch.column(k) for k in (1, 2, 3))):
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(np.frombuffer(at.as_py(), np.int32)),
                     pa.array(np.frombuffer(apart.as_py(), np.int64))], schema.names)

    return named.select("chunk", "ids", "at", "apart").mapInArrow(unpack, schema), centroids


def cluster_report(rows: DataFrame, **options) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per kept vector."""
    spark, shelf = rows.sparkSession, Shelf(rows.sparkSession, "kmeans-report")
    assigned, centroids = clustered(rows, **options)
    assigned = shelf.keep(assigned, "vectors")
    # one row per cluster: as many as there are centroids
    summed = F.sum(F.col("distance").cast("decimal(19,0)")).try_cast("bigint")
    sums = assigned.groupBy("cluster").agg(summed.alias("cluster_inertia"))
    names = spark.createDataFrame([(k, digest(c)) for k, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    total = assigned.agg(summed.alias("inertia"))
    facts = sums.join(F.broadcast(names), "cluster").select("*", total.scalar().alias("inertia"))
    key = options.get("key", "vec_id")
    return assigned.join(F.broadcast(facts), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
