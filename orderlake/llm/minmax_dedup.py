"""Near-duplicate documents by min-max hashing.

A document is the set of its word shingles.  Under each random hash function
both the smallest and the largest value are kept: two unbiased, nearly
independent similarity samples for one evaluation.  The values are banded;
documents that share a band are confirmed on their full sets (see ``linking``).
Documents with equal sets are one class from the start and are compared once;
classes are numbered for this, as one id may have texts in several of them.

Documents without words (or NULL) have no shingle and link with nothing; a text
shorter than a shingle is one shingle.  Repeated rows get the same result each.
Several texts under one id link that id with all they are similar to.  Rows with
a NULL id link with nothing and are kept.  An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.components import components
from orderlake.llm.corpus import Shelf, join_small, mixed, per_text, shingles, signed, word_hashes, words
from orderlake.llm.linking import bands_for, similar_links

SHINGLE = 5
PERCENT = 80
#: Hash values in a band, and the chance that a pair at the threshold shares none.
BAND_ROWS = 6
MISS = 1e-4
SHORT = 4096


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Ascending distinct shingle hashes of a whole text."""
    return np.unique(shingles(word_hashes(words(text)), size))


class MinMaxBands:
    """Band hashes of a shingle set; the functions come from a fixed seed."""

    def __init__(self, bands: int, rows: int = BAND_ROWS, seed: int = 10):
        draw = np.random.default_rng(seed)
        functions = (bands * rows + 1) // 2
        self.factors = draw.integers(1 << 62, size=(functions, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.bands, self.rows = bands, rows

    def of(self, items: np.ndarray) -> np.ndarray:
        low = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(len(self.factors), np.uint64)
        for start in range(0, len(items), SHORT):
            values = self.factors * items[None, start:start + SHORT]
            np.minimum(low, values.min(axis=1), out=low)
            np.maximum(high, values.max(axis=1), out=high)
        # minima and maxima of one function lie in different bands
        slots = np.concatenate([low, np.roll(high, 1)])[:self.bands * self.rows].reshape(self.rows, self.bands)
        out = np.arange(1, self.bands + 1, dtype=np.uint64)
        for row in slots:
            out = mixed(out * np.uint64(0x100000001B3) + row)
        return out


def near_duplicates(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per document.

    Documents are linked when 100 * intersection >= percent * union of their
    sets; a component's id is its smallest document id, which alone is kept.
    """
    shelf = Shelf(documents.sparkSession, "minmax")
    bands = bands_for(percent / 100, BAND_ROWS, MISS)
    texts = documents.select("doc_id", "text")

    def signatures():
        hashes = MinMaxBands(bands)

        def work(values: list) -> list[pa.Array]:
            sets = [shingle_set(t, size) for t in values]
            return [pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signed(hashes.of(s)) if len(s) else None for s in sets], pa.list_(pa.int64()))]

        return work

    marks = shelf.keep(per_text(texts, "text", signatures, "n_shingles bigint, same binary, bands array<bigint>"),
                       "marks")
    able = marks.where("same IS NOT NULL AND doc_id IS NOT NULL")
    classes = shelf.keep(able.groupBy("same").agg(F.min("doc_id").alias("first"))
                         .withColumn("id", F.monotonically_increasing_id()), "classes")
    firsts = (able.join(classes, "same").where("doc_id = first").dropDuplicates(["same"])
              .select("id", F.explode("bands").alias("bucket")))
    buckets = shelf.keep(firsts.select("bucket", "id").dropDuplicates(["bucket", "id"]), "buckets")

    def sets_of(ids: DataFrame, count: int) -> DataFrame:
        def make():
            def work(values: list) -> list[pa.Array]:
                sets = [shingle_set(t, size) for t in values]
                return [pa.array([signed(np.sort(signed(s))) for s in sets], pa.list_(pa.int64())),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())]

            return work

        named = join_small(classes.withColumnRenamed("first", "doc_id"), ids, "id", "inner", count)
        wanted = join_small(texts, named, "doc_id", "inner", count).select("id", "same", "text")
        return (per_text(wanted, "text", make, "items array<bigint>, read binary").where("read = same")
                .select("id", "items").dropDuplicates(["id"]))

    links = similar_links(buckets, sets_of, percent, shelf).unionByName(same_document(able, classes, shelf))
    tree = components(links, shelf, "all")
    placed = shelf.keep(classes.join(tree, classes.id == tree.node, "left")
                        .select("same", "first", F.coalesce("component", "id").alias("component")), "placed")
    lowest = placed.groupBy("component").agg(F.min("first").alias("lowest"))
    found = shelf.keep(placed.join(lowest, "component").select("same", "lowest"), "found")
    return (marks.select("doc_id", "n_shingles", "same").join(found, "same", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("lowest", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def same_document(able: DataFrame, classes: DataFrame, shelf: Shelf) -> DataFrame:
    """Links ``a, b`` among the classes that one document id has texts in: all to the first of them."""
    again = shelf.keep(able.groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    of_id = join_small(able.select("doc_id", "same"), again, "doc_id", "left_semi", again.count())
    nodes = shelf.keep(of_id.join(classes, "same").select("doc_id", "id").distinct(), "classes-of-ids")
    firsts = nodes.groupBy("doc_id").agg(F.min("id").alias("b"))
    return nodes.join(firsts, "doc_id").where("id != b").select(F.col("id").alias("a"), "b")
