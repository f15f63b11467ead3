"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The distinct 3-, 5- and 7-grams of a lower-cased text are hashed to buckets, which
take several times its room: only texts are written aside and sent to the workers, which
find the buckets where they need them, a document at a time.  Document
counts of both classes give each bucket its smoothed log-count ratio; buckets
whose ratio is within a few standard errors of zero get the ratio 0 and so leave
the model.  A logistic regression is fitted on the scaled indicators by L-BFGS,
whose losses and gradients are summed over the partitions on the workers.

Only the text is ever an input of a score.  NULL texts score like empty ones.
Several labels of one document count as the larger one.  Without labels of both
classes every text gets the share of class 1 among the labels, or 0 without any.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.corpus import (Shelf, crc_class, fresh, labelled_sample, per_partition, per_text,
                                  summed_blocks)

#: Labelled documents to fit on at most (expected size of a sample by id hash).
MOST_LABELLED = 30_000
BITS = 20
SIZES = (3, 5, 7)
MIN_DOCUMENTS = 5
STANDARD_ERRORS = 3.0
PENALTY = 0.3
ROUNDS = 25
REJECT_FROM = 0.5
BLOCKS = 32
#: Partitions of the (bounded) sample, whatever the number of partitions it came from.
PARTS = 16
#: Documents whose n-grams a task works on at a time.
ROWS = 256


def buckets(text: str | None) -> np.ndarray:
    """Buckets of all n-grams of a text, repeats included."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = (codes + np.uint32(1)) * np.uint32(0x9E3779B1)
    found, rolled = [], np.zeros(len(codes), np.uint32)
    for size in range(1, max(SIZES) + 1):
        if len(codes) < size:
            break
        rolled = rolled[:len(codes) - size + 1] * np.uint32(0x01000193) + codes[size - 1:]
        if size in SIZES:
            found.append(((rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


class Model(NamedTuple):
    """Chosen buckets with their weights (log-count ratio times coefficient) and the constant."""

    chosen: np.ndarray
    weights: np.ndarray
    constant: float

    def scorer(self) -> Callable[[str | None], float]:
        picked = np.zeros(1 << BITS, bool)
        picked[self.chosen] = True
        weight = np.zeros(1 << BITS)
        weight[self.chosen] = self.weights

        def score(text: str | None) -> float:
            found = buckets(text)
            value = self.constant + weight[np.unique(found[picked[found]])].sum()
            return float(1 / (1 + np.exp(-np.clip(value, -500, 500))))

        return score


def minimize(value_and_slope: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray,
             rounds: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with step halving for a smooth convex function."""
    at, (value, slope) = start, value_and_slope(start)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, shares = slope.copy(), []
        for s, y in reversed(steps):
            shares.append(s @ way / (y @ s))
            way -= shares[-1] * y
        if steps:
            s, y = steps[-1]
            way *= (s @ y) / (y @ y)
        else:
            way /= max(1.0, np.linalg.norm(way))
        for (s, y), share in zip(steps, reversed(shares)):
            way += s * (share - y @ way / (y @ s))
        step = 1.0
        while step > 1e-6:
            there = at - step * way
            new_value, new_slope = value_and_slope(there)
            if new_value <= value - 1e-4 * step * (slope @ way):
                break
            step /= 2
        else:
            break
        if (there - at) @ (new_slope - slope) > 1e-12:
            steps = [*steps, (there - at, new_slope - slope)][-memory:]
        done = value - new_value < 1e-5 * max(1.0, abs(value))
        at, value, slope = there, new_value, new_slope
        if done:
            break
    return at


def once(found: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Each of the buckets once, in any order; ``room`` has a number per bucket, whatever it is."""
    places = np.arange(len(found), dtype=np.int32)
    room[found] = places
    return found[room[found] == places]


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list]]:
    """The first column and the texts of the second, some rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part.column(0), part.column(1).to_pylist()


def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """The first column, the owner of each number of the second (lists), and these numbers; some rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            sizes, flat = np.diff(part.column(1).offsets.to_numpy()), part.column(1).flatten().to_numpy()
            yield part.column(0), np.repeat(np.arange(len(sizes)), sizes), flat


def in_blocks(numbers: np.ndarray) -> dict[str, list]:
    return {"block": list(range(BLOCKS)), "value": [b.tobytes() for b in np.array_split(numbers, BLOCKS)]}


def summed(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], dict[str, list]], kind: str) -> np.ndarray:
    """The sum over partitions of the numbers ``work`` gives in blocks; only the sum reaches the driver."""
    parts = summed_blocks(per_partition(rows, work, "block int, value binary"), kind).collect()
    return np.concatenate([np.frombuffer(r.value, kind) for r in sorted(parts, key=lambda r: r.block)])


def class_counts(sample: DataFrame) -> np.ndarray:
    """Documents per class and bucket, summed over partitions."""
    def counted(batches: Iterator[pa.RecordBatch]) -> dict[str, list]:
        counts, room = np.zeros((2, 1 << BITS), np.int32), np.zeros(1 << BITS, np.int32)
        for labels, texts in texts_of(batches):
            for label, text in zip(labels.to_pylist(), texts):
                if label in (0, 1):
                    counts[label, once(buckets(text), room)] += 1
        return in_blocks(counts.ravel())

    return summed(sample.select("label", "text"), counted, "<i4").reshape(2, -1).astype(np.int64)


def fit(documents: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0,
        most: int = MOST_LABELLED) -> Model:
    """Learn from labelled documents whose id's crc32 is outside the held-out class."""
    shelf = Shelf(documents.sparkSession, "toxicity")
    sample = shelf.keep(labelled_sample(documents, labels, "toxic", modulus, held_out, most).repartition(PARTS), "sample")
    by_class = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = (sum(n for k, n in by_class.items() if (k > 0) == bool(c)) for c in (0, 1))
    if not n0 or not n1:
        return Model(np.zeros(0, np.int64), np.zeros(0), 30.0 if n1 else -30.0)
    clean, toxic = class_counts(sample)
    ratio = np.log((toxic + 0.5) / (n1 + 1.0)) - np.log((clean + 0.5) / (n0 + 1.0))
    error = np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    chosen = np.flatnonzero((toxic + clean >= MIN_DOCUMENTS) & (np.abs(ratio) >= STANDARD_ERRORS * error))
    place = np.full(1 << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    scale = ratio[chosen]

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, texts in texts_of(batches):
            found = (place[buckets(text)] for text in texts)
            lists = pa.array([np.unique(places[places >= 0]) for places in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([label, lists], ["label", "places"])

    narrow = shelf.keep(sample.select("label", "text").mapInArrow(narrowed, "label int, places array<int>"), "places")

    def loss(point: np.ndarray) -> tuple[float, np.ndarray]:
        weight, constant = point[:-1] * scale, point[-1]

        def partial(batches: Iterator[pa.RecordBatch]) -> dict[str, list]:
            total = np.zeros(len(scale) + 2)  # the slope, then the loss
            for toxic, owner, flat in grams_of(batches):
                label = toxic.to_numpy().astype(float)
                margin = constant + np.bincount(owner, weight[flat], len(label))
                off = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - label
                total[:-2] += np.bincount(flat, off[owner], len(scale)) * scale
                total[-2:] += off.sum(), np.logaddexp(0, margin).sum() - label @ margin
            return in_blocks(total)

        total = summed(narrow, partial, "<f8")
        return (total[-1] + PENALTY / 2 * point[:-1] @ point[:-1],
                total[:-1] + PENALTY * np.append(point[:-1], 0.0))

    start = np.append(np.zeros(len(chosen)), np.log(n1 / n0))
    point = minimize(loss, start, ROUNDS)
    return Model(chosen, point[:-1] * scale, float(point[-1]))


def scored(documents: DataFrame, model: Model, name: str = "score", keep_text: bool = False) -> DataFrame:
    """The other columns and each whole text's score under the given name."""
    def make():
        score = model.scorer()
        return lambda texts: [pa.array([score(t) for t in texts], pa.float64())]

    return per_text(documents, "text", make, f"{name} double", keep_text)


def judged(documents: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    model = fit(documents, labels, modulus, held_out)
    return (scored(documents.select("doc_id", "text"), model)
            .select("doc_id", (crc_class("doc_id", modulus) == held_out).alias("held_out"), "score",
                    (F.col("score") >= REJECT_FROM).cast("int").alias("predicted")))


def kept(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    score = fresh(documents, "_score")
    rows = scored(documents, fit(documents, labels), score, keep_text=True)
    return rows.where(F.col(score) < REJECT_FROM).select(*documents.columns)
