"""Nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots.  The index is cut
into shards; each shard posts its vectors, with the position each pivot has in
their order, in one inverted file per pivot.  A query walks the files of its own
nearest pivots and adds up the footrule distance of the two orders (a pivot
missing in one of them stands behind its last).  The best share of a shard by
footrule, ties included, is reranked by the exact inner product; the best of all
shards are the answer.

Largest inner products are nearest neighbours after one more coordinate lifts
all indexed vectors to the largest norm; pivots are compared in that form.

Every vector is indexed.  Pivots are drawn from a bounded sample; ``measured_recall``
compares with brute force.  Queries go against all shards in blocks, so a task
holds one shard and one block, however large the table or a group of copies is.

Vectors that are NULL, zero, hold NULL or non-finite components, or differ in length
from most take no part; repeated ids count once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.corpus import Shelf, share_of
from orderlake.llm.vectors import matrix, usable_rows

PIVOTS = 192
PREFIX = 96
#: Rows that pivots are drawn from at most (expected size of a sample by id hash).
PIVOT_SAMPLE = 4096
#: Share of a shard that is reranked, and its least size.
RERANKED = 0.2
RERANKED_LEAST = 256
SHARD = 4096
QUERY_BLOCK = 2048
SCHEMA = "query_id bigint, vec_id bigint, score double, shard int"


def chosen_pivots(sample: np.ndarray, count: int = PIVOTS, seed: int = 4) -> np.ndarray:
    """Pivots in random order of the sample, no two of them nearly in one direction."""
    order = np.random.default_rng(seed).permutation(len(sample))
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen: list[int] = []
    for i in order:
        if len(chosen) == count:
            break
        if not chosen or (unit[chosen] @ unit[i]).max() < 0.9:
            chosen.append(i)
    return sample[chosen]


def lifted(vectors: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the coordinate that brings all to the same norm."""
    rest = np.sqrt(np.maximum(top * top - (vectors * vectors).sum(axis=1), 0.0))
    return np.hstack([vectors, rest[:, None]])


def pivot_orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of each vector's nearest pivots, nearest first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int32)


class PivotFiles:
    """Inverted files of one shard: a pivot's file has its place in the order of each row, ``prefix`` if none."""

    def __init__(self, orders: np.ndarray, pivots: int):
        rows, self.prefix = orders.shape
        self.places = np.full((pivots, rows), self.prefix, np.int16)
        self.places[orders, np.arange(rows)[:, None]] = np.arange(self.prefix, dtype=np.int16)

    def footrules(self, orders: np.ndarray) -> np.ndarray:
        """Distance of each query's order to each row's, from the files of the query's pivots alone.

        A pivot of both counts |i - j|, one of the query alone ``prefix - i``; what
        the rows' other pivots add is their common total less that of the shared
        ones.  Together a file adds 2 max(i, j) - i - prefix.
        """
        own = np.arange(self.prefix, dtype=np.int16)
        fixed = self.prefix * (self.prefix + 1) // 2 - self.prefix * self.prefix - int(own.sum())
        return np.array([fixed + 2 * np.maximum(self.places[order], own[:, None]).sum(axis=0, dtype=np.int32)
                         for order in orders])


def nearest(embeddings: DataFrame, top_k: int = 20, query_modulus: int = 20, reranked: float = RERANKED,
            key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest of every row whose id the modulus divides."""
    spark = embeddings.sparkSession
    rows = Shelf(spark, "permutation").keep(
        usable_rows(embeddings, key, vector).select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v")),
        "vectors")
    count, largest, dim = rows.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)),
                                   F.max(F.size("v"))).first()
    if not count:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    largest = math.sqrt(largest)
    drawn = rows.where(share_of("id", min(1.0, PIVOT_SAMPLE / count))).orderBy("id").select("v").toArrow()
    if not drawn.num_rows:
        drawn = rows.select("v").limit(1).toArrow()
    pivots = chosen_pivots(lifted(matrix(drawn.column(0), dim), largest))
    prefix = min(PREFIX, len(pivots))
    is_query = F.col("id") % query_modulus == 0
    shards = math.ceil(count / SHARD)
    blocks = math.ceil(rows.where(is_query).count() / QUERY_BLOCK)
    spread = F.xxhash64("id")
    index = rows.select("id", "v", F.pmod(spread, F.lit(shards)).cast("int").alias("shard"),
                        F.explode(F.sequence(F.lit(0), F.lit(max(0, blocks - 1)))).alias("block"))
    # other names: both sides of a cogroup need columns of their own
    queries = rows.where(is_query).select(F.col("id").alias("query_id"), F.col("v").alias("query"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(max(1, blocks)))
                                          .cast("int").alias("block"),
                                          F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))

    def search(part: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if part.num_rows and asked.num_rows:
            vectors, ids = matrix(part.column("v"), dim), part.column("id").to_numpy()
            wanted, query_ids = matrix(asked.column("query"), dim), asked.column("query_id").to_numpy()
            shard = part.column("shard")[0].as_py()
            files = PivotFiles(pivot_orders(lifted(vectors, largest), pivots, prefix), len(pivots))
            orders = pivot_orders(np.hstack([wanted, np.zeros((len(wanted), 1))]), pivots, prefix)
            most = min(len(ids), max(RERANKED_LEAST, math.ceil(reranked * len(ids))))
            for first in range(0, len(wanted), 256):
                for near, query, query_id in zip(files.footrules(orders[first:first + 256]),
                                                 wanted[first:first + 256], query_ids[first:first + 256]):
                    limit = np.partition(near, most - 1)[most - 1]
                    rows_near = np.flatnonzero((near <= limit) & (ids != query_id))
                    scores = vectors[rows_near] @ query
                    if len(scores) > top_k:  # only what reaches the last place, ties included, is sorted
                        reached = scores >= np.partition(scores, len(scores) - top_k)[len(scores) - top_k]
                        rows_near, scores = rows_near[reached], scores[reached]
                    best = np.lexsort((ids[rows_near], -scores))[:top_k]
                    out += [(int(query_id), int(ids[rows_near[b]]), float(scores[b]), shard) for b in best]
        columns = list(zip(*out)) or [()] * 4
        return pa.table({n: pa.array(c, t) for n, c, t in zip(
            ("query_id", "vec_id", "score", "shard"), columns, (pa.int64(), pa.int64(), pa.float64(), pa.int32()))})

    found = (index.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(search, SCHEMA))
    nearest_first = [F.desc("score"), F.asc("vec_id")]
    place = F.row_number()
    some = (found.withColumn("part", F.col("shard") % 64)
            .withColumn("rank", place.over(Window.partitionBy("query_id", "part").orderBy(*nearest_first)))
            .where(F.col("rank") <= top_k))
    return (some.withColumn("rank", place.over(Window.partitionBy("query_id").orderBy(*nearest_first)))
            .where(F.col("rank") <= top_k).select("query_id", "rank", "vec_id", "score"))


def measured_recall(embeddings: DataFrame, found: DataFrame, queries: int = 64, top_k: int = 20) -> float:
    """Share of the true nearest neighbours of a bounded number of queries that ``found`` holds."""
    asked = [r.query_id for r in found.select("query_id").distinct().orderBy(F.xxhash64("query_id")).limit(queries)
             .collect()]
    rows = usable_rows(embeddings, "vec_id", "embedding")
    wanted = F.broadcast(rows.where(F.col("vec_id").isin(asked)).select(F.col("vec_id").alias("query_id"),
                                                                        F.col("embedding").alias("query")))
    score = F.aggregate(F.zip_with("embedding", "query", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    scored = (rows.withColumn("_one", F.lit(1)).join(wanted.withColumn("_one", F.lit(1)), "_one")
              .where("vec_id != query_id").select("query_id", "vec_id", score.alias("score")))
    best = (scored.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= top_k))
    hits = best.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    return hits / max(1, best.count())
