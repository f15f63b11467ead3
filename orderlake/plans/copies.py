"""Copies among the rows of a delivery, found with intermediate results written aside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions import all_present
from orderlake.operators import duplicates
from orderlake.sources.tables import Stage


def flag_copies(stage: Stage, rows: DataFrame, signature: list[str]) -> DataFrame:
    """As :func:`duplicates.flag_copies`, shuffling eight bytes per row and the few rows that may be copies.

    The rows that may be are written aside and compared in full; all others have
    one copy and stay where they are, whatever the number of copies.
    """
    told = tell_copies(stage, rows, signature)
    suspects = stage.keep(told.where("_is_suspect").drop("_is_suspect"), "suspect_rows")
    others = told.where("NOT _is_suspect").drop("_is_suspect").withColumn("has_one_copy", all_present(signature))
    return others.unionByName(flag_suspects(stage, suspects, signature))


def tell_copies(stage: Stage, rows: DataFrame, signature: list[str]) -> DataFrame:
    """Add ``_is_suspect``: true for all copies and few others.

    Hashes that occur more than once are folded into bits of a bounded number, which
    every task gets.
    """
    words = stage.keep(duplicates.suspect_words(duplicates.suspect_parts(rows, signature)), "suspect_words")
    return duplicates.tell_suspects(rows, signature, words)


def flag_suspects(stage: Stage, suspects: DataFrame, signature: list[str]) -> DataFrame:
    """:func:`duplicates.flag_copies` for rows read from a table, all that share a signature among them."""
    repeated = stage.keep(duplicates.repeated_signatures(suspects, signature), "repeated_rows")
    return duplicates.flag_copies(suspects, signature, repeated)
