"""Raw delimited files: every column is text, nothing is inferred or rejected."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Headers that are looked up at the same time; each is a job that reads the first line of one file.
HEADERS_AT_ONCE = 16


def read_text_columns(spark: SparkSession, path: str | list[str],
                      columns: list[str] | None = None) -> DataFrame:
    """Header CSV as strings; an empty field is NULL.

    With ``columns`` the header of every file is checked against the contract,
    so a missing or moved column fails instead of shifting values.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def files_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Addresses of the files behind a path or several, from the listing."""
    return sorted(re.sub("^file:/+", "file:/", unquote(name)) for name in spark.read.text(path).inputFiles())


def new_columns(header: list[str], columns: list[str], reserved: list[str]) -> list[str]:
    """The columns of a header that the contract doesn't name.

    A contract column that is missing, or stands before one that the contract
    puts in front of it, is an error; so is a new column with a reserved name.
    """
    places = {name.lower(): place for place, name in enumerate(header)}
    missing = [name for name in columns if name.lower() not in places]
    if missing:
        raise ValueError(f"header {header} lacks {missing}")
    order = [places[name.lower()] for name in columns]
    if order != sorted(order):
        raise ValueError(f"header {header} has its columns in another order than {columns}")
    known = {name.lower() for name in columns}
    extra = [name for name in header if name.lower() not in known]
    taken = [name for name in extra if name.startswith("_") or name.lower() in {r.lower() for r in reserved}]
    if taken:
        raise ValueError(f"header {header} uses reserved names {taken}")
    return extra


def read_delivery(spark: SparkSession, path: str | list[str], columns: list[str], source: Column,
                  source_name: str, reserved: list[str]) -> tuple[DataFrame, list[str]]:
    """All files of a delivery, whatever columns they bring beyond the contract, and those columns' names.

    Files with the same header are one scan, which holds every file against that
    header; rows of files without a column have NULL there.  An empty file has no
    header and no row.  ``source`` is evaluated on the scans.
    """
    files = files_of(spark, path)
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(lambda file: tuple(read_text_columns(spark, file).columns), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        groups.setdefault(header or tuple(columns), []).append(file)
    found: dict[str, str] = {}
    rows = None
    for header, group in sorted(groups.items()) or [(tuple(columns), path)]:
        extra = new_columns(list(header), columns, reserved)
        part = read_text_columns(spark, group, list(header)).select(
            *[F.col(f"`{name}`").alias(name) for name in columns],
            *[F.col(f"`{name}`").alias(found.setdefault(name.lower(), name)) for name in extra],
            source.alias(source_name))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows, list(found.values())


def file_uri() -> Column:
    """Full address of the file a row came from; valid directly on a file scan."""
    return F.col("_metadata.file_path")


def file_name() -> Column:
    """Base name of the file a row came from; valid directly on a file scan."""
    return F.col("_metadata.file_name")
