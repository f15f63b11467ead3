"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

Each text becomes a vector of statistics (character classes, word and line
lengths, repetition).  Random cosines of the standardized vector approximate a
Gaussian kernel.  The normal equations of the ridge fit are summed over
partitions and solved once; the scores of a part of the training rows kept out
of the fit are calibrated to probabilities by pooling adjacent violators.

Only the text is ever an input of a score.  NULL texts score like empty ones.
Several labels of one document count as the larger one.  Without labels of both
classes every text gets the share of class 1 among the labels, or 0.5 without any.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.corpus import (Shelf, crc_class, fresh, labelled_sample, per_partition, per_text, share_of,
                                  summed_blocks)

#: Labelled documents to fit on at most (expected size of a sample by id hash).
MOST_LABELLED = 100_000
COSINES = 256
RIDGE = 1.0
CALIBRATED_SHARE = 0.25
KEEP_FROM = 0.7
CLIP = 6.0

# classes of bytes: each counted byte belongs to one
_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n",
            b".", b",", b"!", b"?", b"|", b"*%$&#@~^+=_\\", b"\"'`", b"()[]{}", b"<>", b"/:;", b"-"]
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _k, _members in enumerate(_CLASSES):
    _CLASS_OF[list(_members)] = _k
_CLASS_OF[:32][_CLASS_OF[:32] == len(_CLASSES)] = len(_CLASSES) + 1
N_CLASSES = len(_CLASSES) + 2


def statistics(text: str | None) -> np.ndarray:
    """Statistics of one whole text; all zero for an empty one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(N_CLASSES + 12)
    if not data:
        return out
    counts = np.bincount(_CLASS_OF[np.frombuffer(data, np.uint8)], minlength=N_CLASSES)
    words = data.split()
    n_words, size = max(1, len(words)), len(data)
    out[:N_CLASSES] = np.sqrt(counts / size)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    distinct = len(set(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    seen = {}
    for line in lines:
        seen[line] = seen.get(line, 0) + len(line)
    repeated = sum(v - len(k) for k, v in seen.items())
    pairs = len(set(zip(words, words[1:])))
    ended = sum(x[-1:] in (b".", b"!", b"?", b":") for x in lines)
    out[N_CLASSES:] = (
        np.log1p(len(words)), np.log1p(lengths.mean()), np.log1p(lengths.max()), np.log1p(lengths.std()),
        np.log(distinct + 1) / np.log(n_words + 1), pairs / n_words, repeated / size,
        np.log1p(n_words / max(1, len(lines))), ended / max(1, len(lines)), (lengths <= 3).mean(),
        counts[1] / max(1, counts[0] + counts[1]), (counts[7] + counts[9] + counts[10]) / n_words)
    return out


class Model(NamedTuple):
    """Everything a score needs; a few hundred kilobytes whatever the corpus size."""

    middle: np.ndarray
    spread: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.middle) / self.spread, -CLIP, CLIP)
        out = np.cos(scaled @ self.waves + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([out, np.ones((len(out), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated level; a thousandth of the raw score orders texts of one level."""
        raw = self.raw(stats)
        level = np.interp(raw, self.knots, self.levels)
        return np.clip(0.999 * level + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0.0, 1.0)


def isotonic(at: np.ndarray, ones: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in ascending order; one knot per pooled block."""
    blocks: list[list[float]] = []
    for x, y, n in zip(at, ones, rows):
        blocks.append([x * n, y, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return (np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks]))


def with_statistics(rows: DataFrame) -> DataFrame:
    def make():
        return lambda texts: [pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))]

    return per_text(rows, "text", make, "stats array<double>")


def constant(level: float) -> Model:
    d = N_CLASSES + 12
    return Model(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.array([0.0, 0.5]),
                 np.array([0.0]), np.array([level]))


def fit(documents: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2,
        most: int = MOST_LABELLED, seed: int = 5) -> Model:
    """Learn from labelled documents whose id's crc32 is outside the held-out class."""
    spark = documents.sparkSession
    sample = Shelf(spark, "quality").keep(
        with_statistics(labelled_sample(documents, labels, "quality", modulus, held_out, most)), "stats")
    d = N_CLASSES + 12
    column = [F.get("stats", F.lit(i)) for i in range(d)]
    found = sample.agg(F.count(F.lit(1)), F.avg("label"), *[F.avg(c) for c in column],
                       *[F.stddev_pop(c) for c in column]).first()
    if not found[0] or found[1] in (0.0, 1.0):
        return constant(0.5 if not found[0] else float(found[1]))
    middle, spread = np.array(found[2:2 + d]), np.array(found[2 + d:])
    spread = np.where(spread > 1e-9, spread, 1.0)
    draw = np.random.default_rng(seed)
    waves = draw.normal(size=(d, COSINES)) * np.sqrt(1.0 / d)
    model = Model(middle, spread, waves, draw.uniform(0, 2 * np.pi, COSINES), np.zeros(COSINES + 1),
                  np.zeros(1), np.zeros(1))
    apart = share_of("doc_id", CALIBRATED_SHARE, salt=1)
    width = COSINES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> dict[str, list]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            x = model.features(np.array(batch.column(1).to_pylist()).reshape(-1, d))
            total[:, :width] += x.T @ x
            total[:, width] += x.T @ batch.column(0).to_numpy().astype(float)
        return {"block": list(range(width)), "value": [r.tobytes() for r in total]}

    sums = summed_blocks(per_partition(sample.where(~apart).select("label", "stats"), equations,
                                       "block int, value binary"), "<f8").collect()
    matrix = np.array([np.frombuffer(r.value, "<f8") for r in sorted(sums, key=lambda r: r.block)])
    if not len(matrix):
        return constant(float(found[1]))
    weights = np.linalg.solve(matrix[:, :width] + RIDGE * np.eye(width), matrix[:, width])
    model = model._replace(weights=weights)

    def scored():
        return lambda stats: [pa.array(model.raw(np.array(stats).reshape(-1, d)), pa.float64())]

    # at most a few thousand bins of raw scores reach the driver
    bins = (per_text(sample.where(apart).select("label", "stats"), "stats", scored, "raw double")
            .groupBy(F.round(F.col("raw") * 1024).cast("int").alias("bin"))
            .agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect())
    if not bins:
        return model._replace(knots=np.array([0.0, 1.0]), levels=np.array([0.0, 1.0]))
    knots, levels = isotonic(np.array([b.bin / 1024 for b in bins]), np.array([float(b.ones) for b in bins]),
                             np.array([float(b.n) for b in bins]))
    return model._replace(knots=knots, levels=levels)


def scored(documents: DataFrame, model: Model, name: str = "score", keep_text: bool = False) -> DataFrame:
    """The other columns and each whole text's score under the given name."""
    def make():
        return lambda texts: [pa.array(model.score(np.array([statistics(t) for t in texts])), pa.float64())]

    return per_text(documents, "text", make, f"{name} double", keep_text)


def judged(documents: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    model = fit(documents, labels, modulus, held_out)
    return (scored(documents.select("doc_id", "text"), model)
            .select("doc_id", (crc_class("doc_id", modulus) == held_out).alias("held_out"), "score",
                    (F.col("score") >= KEEP_FROM).cast("int").alias("predicted")))


def kept(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    score = fresh(documents, "_score")
    rows = scored(documents, fit(documents, labels), score, keep_text=True)
    return rows.where(F.col(score) >= KEEP_FROM).select(*documents.columns)
