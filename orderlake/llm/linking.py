"""Exact similarity links among things that share hash buckets, without all pairs of a bucket.

In each bucket every member is first compared with one pivot, the member with
most company over all its buckets.  Jaccard distance is a metric, so with the
distances to the pivot known, two members can only be similar if these differ by
no more than the allowed distance.  What the pivot has not joined to its own
component is therefore compared only with members in that reach, of another
component and of a fitting size.  Items of such a member that no other of them
has bound what it can share: in a crowd of edited copies, many have too many
items of their own to be similar to any other.  For the rest, one-bit sketches
of the full sets leave out pairs five standard deviations from the threshold.
What remains is confirmed or refuted on full sets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.components import components
from orderlake.llm.corpus import Shelf, join_small, mixed

#: Longs of a sketch.
WORDS = 16
SetsOf = Callable[[DataFrame, int], DataFrame]


def bands_for(threshold: float, rows: int, miss: float) -> int:
    """Bands of ``rows`` hashes with which a pair at the threshold stays unseen with at most this probability."""
    return math.ceil(math.log(miss) / math.log1p(-threshold ** rows))


def compared(pairs: DataFrame, sets: DataFrame, shelf: Shelf, name: str) -> DataFrame:
    """``a, b, shared, total``: sizes of the intersection and union of both ends' full sets."""
    rows = (pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("items_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("items").alias("items_b")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            shared, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
                both = np.sort(np.concatenate([x, y]))
                shared[i] = (both[1:] == both[:-1]).sum()
                total[i] = len(both) - shared[i]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared), pa.array(total)],
                                             ["a", "b", "shared", "total"])

    return shelf.keep(rows.select("a", "b", "items_a", "items_b")
                      .mapInArrow(run, "a bigint, b bigint, shared bigint, total bigint"), f"{name}-compared")


def similar_links(buckets: DataFrame, sets_of: SetsOf, percent: int, shelf: Shelf) -> DataFrame:
    """Links ``a, b`` (a > b) whose components are those of all similar pairs sharing a bucket.

    ``buckets``: kept rows ``bucket, id``, each pair of bucket and id once.
    ``sets_of(ids, count)`` gives ``id, items``, each set ascending without repeats.
    Similar: 100 * intersection >= percent * union.
    """
    crowds = shelf.keep(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "crowds")
    members = shelf.keep(join_small(buckets, crowds, "bucket", "inner", crowds.count()), "members")
    company = members.groupBy("id").agg(F.sum("n").alias("company"))
    pivots = (members.join(company, "id").groupBy("bucket")
              .agg((-F.max(F.struct("company", (-F.col("id")).alias("id")))["id"]).alias("pivot")))
    star = shelf.keep(members.drop("n").join(pivots, "bucket").where("id != pivot"), "star")
    pair = [F.greatest("id", "pivot").alias("a"), F.least("id", "pivot").alias("b")]
    pairs = shelf.keep(star.select(*pair).distinct(), "star-pairs")
    ends = shelf.keep(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "star-ends")
    sets = shelf.keep(sets_of(ends, ends.count()), "star-sets")
    first = compared(pairs, sets, shelf, "star")
    similar = F.lit(100) * F.col("shared") >= F.lit(percent) * F.col("total")
    links = shelf.keep(first.where(similar).select("a", "b"), "star-links")
    tree = components(links, shelf, "star")

    # members that the pivot of a bucket did not reach
    apart = first.select("a", "b", (1 - F.col("shared") / F.col("total")).alias("apart"))
    of_id = tree.select(F.col("node").alias("id"), F.col("component").alias("of_id"))
    of_pivot = tree.select(F.col("node").alias("pivot"), F.col("component").alias("of_pivot"))
    placed = (star.select("bucket", "id", "pivot", *pair).join(apart, ["a", "b"])
              .join(of_id, "id", "left").join(of_pivot, "pivot", "left")
              .select("bucket", "id", "apart", F.coalesce("of_id", "id").alias("component"),
                      (F.coalesce("of_id", "id") != F.coalesce("of_pivot", "pivot")).alias("lone")))
    placed = shelf.keep(placed, "placed")
    lone_buckets = shelf.keep(placed.where("lone").select("bucket").distinct(), "lone-buckets")
    if lone_buckets.isEmpty():
        return links
    crowd = shelf.keep(join_small(placed, lone_buckets, "bucket", "left_semi", lone_buckets.count()), "lone-crowd")
    ids = shelf.keep(crowd.select("id").distinct(), "lone-ids")
    bound = shelf.keep(shareable(join_small(sets, ids, "id", "left_semi", ids.count())), "shareable")
    able = bound.where(100 * F.col("most") >= percent * F.col("size")).select("id", "most", "size")
    able = sketched(sets.join(shelf.keep(able, "able-ids"), "id").select("id", "most", "size", "items"))
    homes = crowd.groupBy("id").agg(F.array_sort(F.collect_list("bucket")).alias("homes"))
    crowd = shelf.keep(crowd.join(able, "id").join(homes, "id"), "able")
    x, y = crowd.where("lone").alias("x"), crowd.alias("y")
    reach = F.lit(1 - percent / 100 + 1e-9)
    most = F.least("x.most", "y.most")
    apart_bits = sum((F.bit_count(F.col(f"x.s{k}").bitwiseXOR(F.col(f"y.s{k}"))) for k in range(WORDS)), F.lit(0))
    # a pair is taken in the first of the buckets it shares
    met = (x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") != F.col("y.component"))
                  & (F.abs(F.col("x.apart") - F.col("y.apart")) <= reach)
                  & (100 * most >= percent * (F.col("x.size") + F.col("y.size") - most))
                  & (~F.col("y.lone") | (F.col("x.id") > F.col("y.id")))
                  & (apart_bits <= F.lit(most_apart(percent)))
                  & (F.array_min(F.array_intersect("x.homes", "y.homes")) == F.col("x.bucket")))
           .select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")).distinct())
    rest = shelf.keep(met.join(first, ["a", "b"], "left_anti"), "rest-pairs")
    second = compared(rest, sets, shelf, "rest")
    return links.union(second.where(similar).select("a", "b"))


def shareable(sets: DataFrame) -> DataFrame:
    """``id, size, most``: size of each set and how many of its items any other of these sets has."""
    own = (sets.select("id", F.explode("items").alias("item")).groupBy("item")
           .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).where("n = 1")
           .groupBy("id").agg(F.count(F.lit(1)).alias("own")))
    size = sets.select("id", F.size("items").cast("bigint").alias("size"))
    return size.join(own, "id", "left").select("id", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("most"))


def most_apart(percent: int) -> int:
    """Differing bits that sets at the threshold exceed with a chance below one in a million."""
    differ, bits = (1 - percent / 100) / 2, 64 * WORDS
    return math.ceil(bits * differ + 5 * math.sqrt(bits * differ * (1 - differ)))


def sketched(rows: DataFrame) -> DataFrame:
    """``id, most, size`` and a one-bit min-max sketch of the items in ``WORDS`` longs."""
    factors = np.random.default_rng(16).integers(1 << 62, size=(32 * WORDS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    names = [f"s{k}" for k in range(WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, WORDS), np.int64)
            items = batch.column(3)
            for i in range(batch.num_rows):
                own = items[i].values.to_numpy().view(np.uint64)
                low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
                high = np.zeros(len(factors), np.uint64)
                for start in range(0, len(own), 512):
                    values = factors * own[None, start:start + 512]
                    np.minimum(low, values.min(axis=1), out=low)
                    np.maximum(high, values.max(axis=1), out=high)
                bits = mixed(np.concatenate([low, high])) & np.uint64(1)
                out[i] = np.packbits(bits.astype(np.uint8)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, out.T.copy())],
                                             ["id", "most", "size", *names])

    return rows.mapInArrow(run, "id bigint, most bigint, size bigint, " + ", ".join(f"{n} bigint" for n in names))
