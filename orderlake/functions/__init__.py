"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(condition: Column) -> Column:
    """Two-valued reading of a condition: NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def has_outer_spaces(name: str) -> Column:
    return F.length(F.col(name)) != F.length(F.trim(F.col(name)))


def tidy_lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def not_positive_or_missing(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) <= 0)


def all_present(names: Iterable[str]) -> Column:
    present = F.lit(True)
    for name in names:
        present = present & F.col(name).isNotNull()
    return present


def any_differs(left: str, right: str, names: Iterable[str]) -> Column:
    """True when some column differs between two aliased frames; NULL on either side is no difference."""
    differs = F.lit(False)
    for name in names:
        differs = differs | is_true(F.col(f"{left}.{name}") != F.col(f"{right}.{name}"))
    return differs


def line_value(quantity: str = "quantity", price: str = "unit_price") -> Column:
    return F.round(F.col(quantity) * F.col(price), 2)


def rank_of(name: str, ranks: Mapping[str, int], otherwise: int) -> Column:
    ranked = F.lit(otherwise)
    for label, rank in ranks.items():
        ranked = F.when(F.col(name) == label, F.lit(rank)).otherwise(ranked)
    return ranked


def label_of(name: str, ranks: Mapping[str, int], otherwise: str) -> Column:
    label = F.lit(otherwise)
    for text, rank in ranks.items():
        label = F.when(F.col(name) == rank, F.lit(text)).otherwise(label)
    return label


def month_of(name: str) -> Column:
    """The month of a date as ``yyyy-MM``; NULL for NULL."""
    return F.date_format(F.col(name), "yyyy-MM")


def moment(text: str) -> Column:
    """A timestamp literal in the session time zone, e.g. ``2026-06-02 00:00:00``."""
    return F.lit(text).cast("timestamp")
