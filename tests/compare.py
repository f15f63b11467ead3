"""Runs catalog queries in Spark and their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def spark_bag(frame):
    return as_bag(frame.columns, [tuple(r) for r in frame.collect()])


def duck_bag(connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return as_bag(columns, result.fetchall())


# DuckDB type name -> the Spark type it must come with
SAME_TYPE = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DATE": "date", "BOOLEAN": "boolean",
             "DOUBLE": "double", "TIMESTAMP": "timestamp"}


def type_differences(frame, connection, sql):
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    expected = {name: SAME_TYPE.get(kind, kind.lower()) for name, kind, *_ in described}
    actual = {f.name: f.dataType.simpleString().replace("timestamp_ntz", "timestamp") for f in frame.schema}
    return {n: (actual.get(n), expected.get(n)) for n in {*actual, *expected} if actual.get(n) != expected.get(n)}
