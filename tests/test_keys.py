"""Replaced key groups and merges that shuffle keys rather than rows."""

import pytest
from pyspark.sql import functions as F

from orderlake.contracts import LINE_BRONZE_KEY, LINE_KEY, TRACKED
from orderlake.operators import merge
from orderlake.plans.lines import LineLake
from orderlake.sources.tables import Stage
from samples import lines, values


@pytest.fixture(scope="module")
def rows(spark):
    few = [dict(order_id=str(n), line_item_seq=str(n)) for n in range(40)]
    copied = [dict(order_id=str(n), line_item_seq=str(100 + n)) for n in (3, 3, 7)]
    odd = [dict(order_id=None), dict(order_id=None), dict(order_id="90", region=None), dict(order_id="91", ingest_date=None)]
    return Stage(spark).keep(lines(spark, *few, *copied, *odd), "rows")


@pytest.mark.parametrize("brought", ["order_id IS NOT NULL", "order_id < 5", "order_id IS NULL", "false"])
def test_replaced_rows_are_those_of_the_plain_way(spark, rows, tmp_path, brought):
    lake = LineLake(spark, str(tmp_path))
    source = Stage(spark).keep(rows.where(brought).withColumn("status", F.lit("SHIPPED")), "source")
    merged = lake.replaced(rows, source, LINE_BRONZE_KEY, "rows")
    assert values(merged, *rows.columns) == values(merge.replace_key_groups(rows, source, LINE_BRONZE_KEY), *rows.columns)


def test_a_batch_that_changes_nothing_writes_nothing_aside(spark, rows):
    held = rows.where("order_id IS NOT NULL").dropDuplicates(LINE_KEY)
    history = merge.open_versions(held.where("order_id < 20"))
    assert merge.arrivals(history, history.select(*held.columns), LINE_KEY, TRACKED).isEmpty()
    batch = held.withColumn("status", F.when(F.col("order_id") == "4", "SHIPPED").otherwise(F.col("status")))
    batch = batch.unionByName(rows.where("order_id IS NULL"))
    found = merge.arrivals(history, batch, LINE_KEY, TRACKED)
    matches = merge.match_versions(history, batch, LINE_KEY, TRACKED)
    assert values(merge.changed_keys(found, LINE_KEY)) == values(merge.changed_keys(matches, LINE_KEY))
    assert (values(merge.arriving_rows(batch, found, LINE_KEY), *batch.columns)
            == values(merge.fresh_rows(batch, matches, LINE_KEY), *batch.columns))
