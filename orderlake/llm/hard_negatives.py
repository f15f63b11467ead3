"""Hard-negative mining with Kronecker-packed products, in whole numbers.

Every component becomes ``floor(256 * x)`` and a row's score is its integer inner product with the anchor.  The
components of many candidates are biased to be non-negative and laid side by side as fields of one wide integer, one
integer per component.  An anchor's component multiplies such an integer once, the products of all components are
added up, and each field then holds the exact biased score of one candidate: fields are wide enough for the largest
possible sum, so none carries into the next.  Taking the bias off again gives the scores.

Candidates stay where they lie.  Anchors go to them in blocks of bounded size (``ANCHORS`` rows in expectation), chosen by a
hash of the id: every task keeps each anchor's best rows, and the winners of the tasks meet in a ranking.  A first
pass finds an anchor's positives, a second one the negatives inside the score window of each positive; both see every row.
Work is anchors times rows by contract, but neither is ever shuffled against the other.

No part is taken by rows with a NULL id, label or vector or any NULL or non-finite component.  Of several rows with
one id the one with the smallest label and vector counts.  Vectors of other lengths count as filled up with zeros;
zero and empty vectors score 0.  Scaled components beyond +-2^24 count as that bound.  Anchors without positives, or
without a negative in the window, have no rows; nor has an empty table.  Equal scores go by the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import mul
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.corpus import Shelf

SCALE = 256
BOUND = 1 << 24
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 30, 90
#: Anchors that are sent to the tasks at a time, in expectation.
ANCHORS = 10_000
#: Candidates whose fields share one wide integer.
FIELDS = 1024
#: Candidates packed at a time.
SLAB = 8192


def whole(name: str) -> Column:
    """The vector in whole numbers, held within the bound."""
    def cell(x: Column) -> Column:
        held = F.greatest(F.lit(float(-BOUND)), F.least(F.lit(float(BOUND)), x.cast("double") * SCALE))
        return F.floor(held).cast("int")

    return F.transform(name, cell)


def candidates(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``id, label, cells``, one row per id."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite
    return (rows.where(F.coalesce(good, F.lit(False)))
            .select(F.col(key).cast("long").alias("id"), F.struct(
                F.col(label).cast("long").alias("label"), whole(vector).alias("cells")).alias("row"))
            .groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.cells"))


class Fields(NamedTuple):
    """How wide a component may get: number of components, bias, and field type."""

    length: int
    bias: int
    kind: str

    @staticmethod
    def for_table(length: int, largest: int) -> Fields:
        bias = max(1, largest)
        highest = max(1, length) * (2 * bias) ** 2
        if highest >= 1 << 62:
            raise ValueError(f"scores of {length} components up to {largest} don't fit a long")
        return Fields(length, bias, "<u4" if highest < 1 << 32 else "<u8")

    def matrix(self, lists: pa.Array) -> np.ndarray:
        """Rows of whole numbers, shorter ones filled up with zeros."""
        sizes, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
        out = np.zeros((len(lists), self.length), np.int64)
        out[np.arange(self.length)[None, :] < sizes[:, None]] = flat
        return out


class Packed:
    """Candidates in wide integers, one per component and group of ``FIELDS`` candidates."""

    def __init__(self, cells: np.ndarray, form: Fields):
        self.form, self.n, self.sums = form, len(cells), cells.sum(1)
        biased = (cells + form.bias).astype(form.kind)
        self.integers = [
            [int.from_bytes(np.ascontiguousarray(biased[first:first + FIELDS, k]).tobytes(), "little")
             for k in range(form.length)] for first in range(0, self.n, FIELDS)]

    def scores(self, anchor: np.ndarray, first: int = 0, last: int | None = None) -> tuple[int, np.ndarray]:
        """Exact inner products with the candidates of all groups that meet ``first`` to ``last``, and where they begin."""
        form, last = self.form, self.n if last is None else last
        factors = (anchor + form.bias).tolist()
        begin = first // FIELDS * FIELDS
        raw = []
        for group in range(first // FIELDS, -(-last // FIELDS)):
            held = min(FIELDS, self.n - group * FIELDS)
            total = sum(map(mul, factors, self.integers[group]))
            raw.append(np.frombuffer(total.to_bytes(held * int(form.kind[-1]), "little"), form.kind))
        biased = np.concatenate(raw).astype(np.int64) if raw else np.zeros(0, np.int64)
        taken = form.bias * (self.sums[begin:begin + len(biased)] + int(anchor.sum()))
        return begin, biased - taken - form.length * form.bias * form.bias


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores, equal ones by the smaller id, in this order."""
    at = np.arange(len(scores))
    if len(scores) > most:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
    return at[np.lexsort((ids[at], -scores[at]))][:most]


class Block(NamedTuple):
    """Some anchors, and per anchor the scores of its positives once they are known."""

    ids: np.ndarray
    labels: np.ndarray
    cells: np.ndarray
    positives: list[list[int]]


def slabs(batches: Iterator[pa.RecordBatch], form: Fields) -> Iterator[tuple[np.ndarray, np.ndarray, Packed]]:
    """Ids, labels and packed components, a slab of candidates at a time, ordered by label."""
    waiting, held = [], 0

    def packed(parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts).combine_chunks()
        ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        cells = form.matrix(rows.column("cells").combine_chunks())
        order = np.lexsort((ids, labels))
        return ids[order], labels[order], Packed(cells[order], form)

    for batch in batches:
        for first in range(0, batch.num_rows, SLAB):
            part = batch.slice(first, SLAB)
            if held and held + part.num_rows > SLAB:
                yield packed(waiting)
                waiting, held = [], 0
            waiting.append(part)
            held += part.num_rows
    if held:
        yield packed(waiting)


def positives_of(block: Block, form: Fields, most: int) -> Callable:
    """Task work: each anchor's best rows of its own label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for ids, labels, packed in slabs(batches, form):
            for a, (anchor, label, cells) in enumerate(zip(block.ids, block.labels, block.cells)):
                first, last = np.searchsorted(labels, label, "left"), np.searchsorted(labels, label, "right")
                if first == last:
                    continue
                begin, scores = packed.scores(cells, first, last)
                mine, named = scores[first - begin:last - begin], ids[first:last]
                other = named != anchor
                mine, named = mine[other], named[other]
                at = best(mine, named, most)
                if a in found:
                    mine, named = np.append(found[a][0], mine[at]), np.append(found[a][1], named[at])
                    at = best(mine, named, most)
                found[a] = [mine[at], named[at]]
        for a, (scores, named) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(named), block.ids[a])), pa.array(named), pa.array(scores)],
                ["anchor_id", "positive_id", "positive_score"])

    return run


def negatives_of(block: Block, form: Fields, most: int, low: int, high: int) -> Callable:
    """Task work: for each anchor and positive score the best rows of other labels within the window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple] = {}
        for ids, labels, packed in slabs(batches, form):
            for a, (label, cells, wanted) in enumerate(zip(block.labels, block.cells, block.positives)):
                if not wanted:
                    continue
                _, scores = packed.scores(cells)
                apart = labels != label
                mine, named = scores[apart], ids[apart]
                for score in wanted:
                    inside = np.flatnonzero((mine >= -(-low * score // 100)) & (mine <= high * score // 100))
                    some, who = mine[inside], named[inside]
                    at = best(some, who, most)
                    some, who = some[at], who[at]
                    if (a, score) in found:
                        some, who = np.append(found[a, score][0], some), np.append(found[a, score][1], who)
                        at = best(some, who, most)
                        some, who = some[at], who[at]
                    if len(some):
                        found[a, score] = (some, who)
        for (a, score), (some, who) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(who), block.ids[a])), pa.array(np.full(len(who), score, np.int64)),
                 pa.array(who), pa.array(some)], ["anchor_id", "positive_score", "negative_id", "negative_score"])

    return run


def ranked(rows: DataFrame, groups: list[str], score: str, key: str, most: int) -> DataFrame:
    """The best rows of each group with their ``rank``; tasks bring a bounded number of rows per group."""
    order = Window.partitionBy(*groups).orderBy(F.desc(score), key)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mined(rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
          positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
          block_rows: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``id``, the key as a long.
    """
    spark, shelf = rows.sparkSession, Shelf(rows.sparkSession, "negatives")
    schema = T._parse_datatype_string("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                      "positive_score bigint, negative_score bigint")
    table = shelf.keep(candidates(rows, key, vector, label), "candidates")
    facts = table.agg(F.max(F.size("cells")), F.max(F.array_max(F.transform("cells", F.abs))),
                      F.count_if(anchors)).first()
    if not facts[2]:
        return spark.createDataFrame([], schema)
    form = Fields.for_table(facts[0], facts[1] or 0)
    blocks, done = -(-facts[2] // block_rows), []
    for number in range(blocks):
        mine = F.pmod(F.xxhash64("id"), F.lit(blocks)) == number
        held = table.where(anchors & mine).toArrow().combine_chunks()
        if not held.num_rows:
            continue
        block = Block(held.column("id").to_numpy(), held.column("label").to_numpy(),
                      form.matrix(held.column("cells").combine_chunks()), [])
        near = shelf.keep(ranked(
            table.mapInArrow(positives_of(block, form, positives),
                             "anchor_id bigint, positive_id bigint, positive_score bigint"),
            ["anchor_id"], "positive_score", "positive_id", positives).drop("rank"), f"positives/{number}")
        # at most `positives` numbers per anchor of the block
        wanted: dict[int, set[int]] = {}
        for r in near.select("anchor_id", "positive_score").distinct().collect():
            wanted.setdefault(r.anchor_id, set()).add(r.positive_score)
        block = block._replace(positives=[sorted(wanted.get(int(i), ())) for i in block.ids])
        far = ranked(
            table.mapInArrow(negatives_of(block, form, negatives, low, high),
                             "anchor_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"),
            ["anchor_id", "positive_score"], "negative_score", "negative_id", negatives)
        result = near.join(far, ["anchor_id", "positive_score"]).select(*schema.names)
        shelf.keep(result, f"mined/{number}")
        done.append(f"{shelf.folder}/mined/{number}")
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)
