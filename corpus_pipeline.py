"""Corpus pipeline: filter, deduplicate and pack documents.

Documents that the quality classifier or the toxicity classifier rejects go, one
document of each near-duplicate group stays, passages repeated across documents
stay in one of them, and what is left is packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import minmax_dedup, packing, quality, substring_dedup, toxicity
from orderlake.llm.corpus import BROADCAST_ROWS, Shelf, fresh, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of sufficient quality."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return toxicity.kept(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: that with the smallest id, once."""
    shelf, key = Shelf(spark, "distinct"), fresh(docs, "_id")
    verdicts = shelf.keep(minmax_dedup.near_duplicates(docs).select(F.col("doc_id").alias(key), "kept"), "verdicts")
    gone = shelf.keep(verdicts.where("NOT kept").select(key).distinct(), "gone")
    left = docs.join(bounded(gone), F.col("doc_id") == F.col(key), "left_anti")
    again = shelf.keep(verdicts.where("kept").groupBy(key).count().where("count > 1").select(key), "again")
    if again.isEmpty():
        return left
    same = F.col("doc_id") == F.col(key)
    return (left.join(bounded(again), same, "left_anti")
            .union(left.join(bounded(again), same, "left_semi").dropDuplicates(["doc_id", "text"])))


def bounded(ids: DataFrame) -> DataFrame:
    """A kept id table, marked for broadcast only while it is small."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that another document keeps."""
    return substring_dedup.cut(docs, substring_dedup.removals(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good),
    ("toxicity", harmless),
    ("MinHash near-dedup", distinct),
    ("substring dedup", unrepeated),
    ("packing", packed),
]

#: Trained models, minimum hashing and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    shelf, docs = Shelf(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shelf.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
