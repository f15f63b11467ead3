"""Every registered query against its SQL text in another engine, on whole tables."""

import os

import pytest

import __spark_entry__ as entry_file
import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")

QUERIES, SQL = entry_file.QUERIES, entry_file.ORACLE_SQL


def test_every_sql_text_has_its_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    connection = compare.duck(SF_DIR)
    columns, rows = compare.spark_bag(frame)
    expected_columns, expected = compare.duck_bag(connection, SQL[name])
    assert columns == expected_columns
    assert not rows - expected and not expected - rows
    assert compare.type_differences(frame, connection, SQL[name]) == {}


def test_entry_returns_the_order_summary(spark):
    frame = entry_file.entry(spark)
    assert frame.columns == ["order_id", "customer_id", "region", "order_date", "line_item_count",
                             "total_quantity", "total_order_value", "status"]
    assert frame.count() > 0
