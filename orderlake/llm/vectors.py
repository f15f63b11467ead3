"""Checks and forms that the vector operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(name: str) -> Column:
    """True for vectors that are not NULL or zero and hold no NULL or non-finite component."""
    finite = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(name).isNotNull() & finite & F.exists(name, lambda x: x != 0), F.lit(False))


def usable_rows(rows: DataFrame, key: str, vector: str, *others: str) -> DataFrame:
    """Usable vectors as doubles, one per id, all of the most common length.

    Rows with a NULL id take no part.  Of several rows with one id the one with
    the smallest vector counts, so that a repeated row counts once.
    """
    good = rows.where(F.col(key).isNotNull() & usable(vector)).select(
        key, F.col(vector).cast("array<double>").alias(vector), *others)
    lengths = (good.groupBy(F.size(vector).alias("length")).count()
               .orderBy(F.desc("count"), "length").limit(1).first())
    if lengths is None:
        return good
    return (good.where(F.size(vector) == lengths.length)
            .groupBy(key).agg(F.min(F.struct(vector, *others)).alias("_row")).select(key, "_row.*"))


def matrix(column, length: int) -> np.ndarray:
    """An Arrow list column of equal lengths as rows of doubles."""
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat, np.float64).reshape(-1, length)
