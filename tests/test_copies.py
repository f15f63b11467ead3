"""Copies and deliveries without a shuffle of whole rows."""

import pytest

from orderlake.contracts import LINE_RULES, LINE_SIGNATURE
from orderlake.operators import duplicates, quality
from orderlake.operators.plan import plan_text
from orderlake.plans import copies, deliveries
from orderlake.sources.tables import Stage
from samples import lines, values


@pytest.fixture(scope="module")
def rows(spark):
    few = [dict(order_id=str(n), line_item_seq=str(n)) for n in range(40)]
    copied = [dict(order_id=str(n), line_item_seq=str(100 + n)) for n in (3, 3, 7)]
    odd = [dict(order_id=None), dict(order_id=None), dict(order_id="90", region=None), dict(order_id="91", ingest_date=None)]
    return Stage(spark).keep(lines(spark, *few, *copied, *odd), "rows")


def test_copies_are_told_as_by_the_plain_way(spark, rows):
    found = copies.flag_copies(Stage(spark), rows, LINE_SIGNATURE)
    assert values(found) == values(duplicates.flag_copies(rows, LINE_SIGNATURE))
    assert found.where("has_one_copy").count() == 39
    assert values(quality.check_flagged(found, LINE_RULES)) == values(quality.check_rows(rows, LINE_RULES, LINE_SIGNATURE))


def test_suspects_of_one_word_keep_their_own_bits(spark):
    hashes = [0, 1, 63, -1, -64, 1 << 45, (1 << 45) + 5]
    words = duplicates.suspect_words(spark.createDataFrame([(h,) for h in hashes], "signature_hash long"))
    bits = {row._word: row._bits & (1 << 64) - 1 for row in words.collect()}
    assert bits == {0: 1 | 2 | 1 << 63, (1 << 19) - 1: 1 | 1 << 63, 1: 1 | 1 << 5}


def test_only_suspects_are_shuffled(spark, rows):
    """However many copies there are, the other rows are held against bounded bits alone."""
    stage = Stage(spark)
    words = stage.keep(duplicates.suspect_words(duplicates.suspect_hashes(rows, LINE_SIGNATURE)), "words")
    told = duplicates.tell_suspects(rows, LINE_SIGNATURE, words)
    assert "Exchange hashpartitioning" not in plan_text(told, mode="simple")
    assert told.where("_is_suspect").count() == 5


def test_lines_are_shuffled_once_for_a_delivery(spark, tmp_path, no_broadcast):
    for name, ddl in {"lineitem": "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, "
                                  "l_extendedprice double, l_returnflag string, l_linestatus string",
                      "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp",
                      "customer": "c_custkey long, c_nationkey int", "nation": "n_nationkey int, n_regionkey int",
                      "region": "r_regionkey int, r_name string"}.items():
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    plan = plan_text(deliveries.raw_lines(spark, str(tmp_path), 1), mode="simple")
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
