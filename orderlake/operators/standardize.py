"""Typing of all-text rows: trim, tolerant casts, lineage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions import is_true, moment


def trim_text(rows: DataFrame) -> DataFrame:
    """Strip outer spaces from every string column, in one projection."""
    return rows.select(*[
        F.trim(F.col(field.name)).alias(field.name)
        if isinstance(field.dataType, T.StringType) else F.col(field.name)
        for field in rows.schema
    ])


def conform(rows: DataFrame, contract: T.StructType) -> DataFrame:
    """Project to ``contract``.  Text that does not parse becomes NULL instead of failing the job.

    A column that the contract names and ``rows`` lacks is an error at analysis time.
    """
    return rows.select(*[
        F.col(field.name).try_cast(field.dataType).alias(field.name) for field in contract
    ])


def fits(text: Column, kind: T.DataType) -> Column:
    """False for text that is a number, but one that ``kind`` can't hold or turns into 0; never NULL."""
    number, held = text.try_cast("double"), text.try_cast(kind)
    # most prices are settled by the first condition, without a second reading of their text
    return is_true(held != 0) | number.isNull() | is_true(number == 0)


def subset_contract(contract: T.StructType, present: list[str]) -> T.StructType:
    """The fields of ``contract`` that ``present`` has, in contract order."""
    return T.StructType([field for field in contract if field.name in present])


def stamp_orders(rows: DataFrame, as_of: str, source: Column, with_time: bool = True) -> DataFrame:
    """Order-grain lineage: load date, source file and (optionally) load time."""
    lineage = {"ingest_date": F.to_date(moment(as_of)), "source_filename": source}
    if with_time:
        lineage["ingest_at"] = moment(as_of)
    return rows.withColumns(lineage)


def stamp_lines(rows: DataFrame, source: Column, loaded_at: str | None = None) -> DataFrame:
    """Line-grain lineage: the file name and (optionally) the load time; the load date is in the data."""
    lineage = {"_source_file": source}
    if loaded_at is not None:
        lineage["_loaded_at"] = moment(loaded_at)
    return rows.withColumns(lineage)
