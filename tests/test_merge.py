"""Upsert, history, reconciliation and business tables."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlake.contracts import LINE_KEY, ORDER_KEY, PROGRESSED, TRACKED, UNCHANGED
from orderlake.operators import gold, merge, reconcile, skew
from samples import lines, orders, values

LATER = "2026-06-02 00:00:00"
AT_LATER = datetime(2026, 6, 2)
VERSION = ("order_id", "status", "is_current", "valid_from", "valid_to")


def history_of(spark, *changes):
    return merge.open_versions(orders(spark, *changes))


def merged(spark, old, new):
    return merge.merge_history(history_of(spark, *old), orders(spark, *[{**n, "ingest_date": "2026-06-02"} for n in new]),
                               ORDER_KEY, TRACKED, LATER)


# --- upsert ---------------------------------------------------------------------------

def test_key_groups_are_replaced_whole_and_twice_is_once(spark):
    old = orders(spark, dict(product_id="P1"), dict(product_id="P2"), dict(order_id="O2"), dict(order_id=None))
    new = orders(spark, dict(product_id="P8"), dict(product_id="P9"), dict(order_id="O3"))
    once = merge.replace_key_groups(old, new, ORDER_KEY)
    assert values(once, "order_id", "product_id") == sorted([
        ("O1", "P8"), ("O1", "P9"), ("O2", "P1"), ("O3", "P1"), (None, "P1")], key=repr)
    assert values(merge.replace_key_groups(once, new, ORDER_KEY)) == values(once)


def test_upsert_takes_new_columns_along(spark):
    new = orders(spark, dict(order_id="O2")).withColumn("channel", F.lit("web"))
    both = merge.upsert(orders(spark, {}), new, ORDER_KEY)
    assert values(both, "order_id", "channel") == [("O1", None), ("O2", "web")]


def test_repeated_batch_keys_stop_the_merge(spark):
    with pytest.raises(Exception, match="more than one batch row per key"):
        merge.upsert(orders(spark, {}), orders(spark, {}, {}), ORDER_KEY).collect()
    keyless = orders(spark, dict(order_id=None), dict(order_id=None))
    assert merge.unique_or_fail(keyless, ORDER_KEY).count() == 2


# --- history ----------------------------------------------------------------------------

def test_changed_unchanged_and_new(spark):
    result = merged(spark, [{}, dict(order_id="O2")], [dict(status="shipped"), dict(order_id="O2", quantity="9"),
                                                       dict(order_id="O3")])
    assert values(result, *VERSION) == sorted([
        ("O1", "placed", False, date(2026, 6, 1), AT_LATER),
        ("O1", "shipped", True, date(2026, 6, 2), None),
        ("O2", "placed", True, date(2026, 6, 1), None),
        ("O3", "placed", True, date(2026, 6, 2), None)], key=repr)


def test_only_the_tracked_column_matters(spark):
    assert merged(spark, [{}], [dict(quantity="9", product_id="P7")]).count() == 1


def test_missing_status_is_no_change(spark):
    assert values(merged(spark, [{}], [dict(status=None)]), "status", "is_current") == [("placed", True)]
    assert values(merged(spark, [dict(status=None)], [{}]), "status", "is_current") == [(None, True)]


def test_missing_key_is_inserted_every_time(spark):
    assert merged(spark, [dict(order_id=None)], [dict(order_id=None, status="shipped")]).count() == 2


def test_closed_versions_stay_and_a_closed_key_may_return(spark):
    twice = merge.merge_history(merged(spark, [{}], [dict(status="shipped")]),
                                orders(spark, dict(status="placed", ingest_date="2026-06-03")),
                                ORDER_KEY, TRACKED, "2026-06-03 00:00:00")
    assert values(twice, "status", "is_current", "valid_to") == sorted([
        ("placed", False, AT_LATER), ("shipped", False, datetime(2026, 6, 3)), ("placed", True, None)], key=repr)


def test_same_batch_again_changes_nothing(spark):
    new = [dict(status="shipped", ingest_date="2026-06-02"), dict(order_id="O3", ingest_date="2026-06-02")]
    once = merged(spark, [{}, dict(order_id="O2")], new)
    again = merge.merge_history(once, orders(spark, *new), ORDER_KEY, TRACKED, "2026-06-09 00:00:00")
    assert values(again) == values(once)


statuses = st.sampled_from(["placed", "shipped", "delivered"])
batches = st.lists(st.dictionaries(st.sampled_from(["O1", "O2", "O3", "O4"]), statuses, min_size=1), min_size=1, max_size=3)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches)
def test_history_follows_a_plain_model(spark, days):
    """Each key has the run of distinct successive statuses as versions, the last one current."""
    expected: dict[str, list[str]] = {}
    table = None
    for number, day in enumerate(days, start=1):
        for key, status in day.items():
            runs = expected.setdefault(key, [])
            if not runs or runs[-1] != status:
                runs.append(status)
        batch = orders(spark, *[dict(order_id=k, status=s, ingest_date=f"2026-06-0{number}") for k, s in day.items()])
        as_of = f"2026-06-0{number} 00:00:00"
        table = merge.open_versions(batch) if table is None else \
            merge.merge_history(table, batch, ORDER_KEY, TRACKED, as_of)
    rows = [(k, s, i == len(runs) - 1) for k, runs in expected.items() for i, s in enumerate(runs)]
    assert values(table, "order_id", "status", "is_current") == sorted(rows, key=repr)


# --- reconciliation -----------------------------------------------------------------------

def test_reconciliation(spark):
    history = merged(spark, [{}, dict(order_id="O2"), dict(order_id="O3")],
                     [dict(status="shipped"), dict(order_id="O2", status="shipped"), dict(order_id="O3")])
    right = spark.createDataFrame([("O1", PROGRESSED), ("O2", PROGRESSED), ("O3", UNCHANGED)],
                                  "order_id string, expected_category string")
    wrong = spark.createDataFrame([("O1", UNCHANGED), ("O2", PROGRESSED), ("O3", PROGRESSED)],
                                  "order_id string, expected_category string")
    assert reconcile.reconciliation(history, right).first().is_match is True
    for check in (reconcile.missing_history, reconcile.unexpected_history, reconcile.wrong_history):
        assert check(history, right).count() == 0
    assert values(reconcile.missing_history(history, wrong)) == [("O3",)]
    assert values(reconcile.unexpected_history(history, wrong)) == [("O1",)]
    assert values(reconcile.wrong_history(history, wrong)) == [("O1",)]
    assert values(reconcile.reconciliation(history, wrong)) == [(2, 2, 1, 1, False)]
    log = gold.status_change_log(history, LATER)
    assert values(log, "order_id") == [("O1",), ("O1",), ("O2",), ("O2",)]
    assert reconcile.version_mismatches(log).count() == 0
    assert values(reconcile.version_mismatches(log.where("is_current"))) == [("O1", 1), ("O2", 1)]


# --- business tables ------------------------------------------------------------------------

def test_revenue_and_status_counts(spark):
    rows = orders(spark, dict(quantity="3", unit_price="0.35"), dict(order_id="O2"), dict(order_id="O3", unit_price=None),
                  dict(order_id=None, status="shipped"))
    assert values(gold.daily_revenue(rows), "product_id", "daily_sum") == [("P1", Decimal("43.05"))]
    assert values(gold.status_counts(rows)) == [("placed", 3), ("shipped", 0)]


def test_order_summary_takes_current_lines_and_the_lowest_status(spark):
    rows = merge.open_versions(lines(
        spark, dict(status="DELIVERED"), dict(line_item_seq="2", status="PROCESSING", quantity="3", unit_price="0.10"),
        dict(order_id="2", status="RETURNED"), dict(order_id="2", customer_id="8", status="CANCELLED"),
        dict(order_id="2", customer_id="8", status="RETURNED")))
    closed = rows.withColumn("is_current", F.lit(False))
    summary = gold.order_summary(rows.unionByName(closed))
    assert values(summary, "order_id", "customer_id", "line_item_count", "total_quantity", "total_order_value", "status") == [
        ("1", "7", 2, 5, Decimal("21.30"), "PROCESSING"),
        ("2", "7", 1, 2, Decimal("21.00"), "UNKNOWN"),
        ("2", "8", 2, 4, Decimal("42.00"), "CANCELLED")]
    region = gold.region_daily(summary)
    assert values(region) == [("ASIA", date(2026, 1, 5), 2, 11, Decimal("84.30"), Decimal("42.15"))]
    assert values(gold.status_mix(rows, "1")) == [("DELIVERED", 1), ("PROCESSING", 1)]


def test_mean_order_value_rounds_half_up(spark):
    rows = merge.open_versions(lines(spark, dict(quantity="1", unit_price="0.01"), dict(order_id="2", quantity="1", unit_price="0.02")))
    assert gold.region_daily(gold.order_summary(rows)).first().avg_order_value == Decimal("0.02")


def test_line_history_key_is_order_and_line(spark):
    old = merge.open_versions(lines(spark, {}, dict(line_item_seq="2")))
    new = lines(spark, dict(line_item_seq="2", status="SHIPPED", ingest_date="2026-06-02"))
    result = merge.merge_history(old, new, LINE_KEY, TRACKED, LATER)
    assert values(result, "line_item_seq", "status", "is_current") == [
        (1, "PLACED", True), (2, "PLACED", False), (2, "SHIPPED", True)]


# --- skew -----------------------------------------------------------------------------------

def test_skew_against_counting(spark):
    data = [("a" if i % 3 else f"k{i}", None if i % 2 else i % 7) for i in range(300)]
    frame = spark.createDataFrame(data, "name string, number int")
    counts = skew.value_counts(frame)
    stats = {r.column_name: r for r in skew.skew_stats(counts).collect()}
    tally = {}
    for name, _ in data:
        tally[name] = tally.get(name, 0) + 1
    line = stats["name"]
    assert (line.max_count, line.min_count, line.distinct_keys) == (max(tally.values()), 1, len(tally))
    assert line.avg_count == pytest.approx(300 / len(tally))
    assert line.skew_flag == "HIGH" and stats["number"].distinct_keys == 8
    for top_n in (1, 5, 60):
        best = skew.heaviest_keys(counts, top_n, slices=4).where("column_name = 'name'").orderBy("key_rank")
        expected = sorted(tally.items(), key=lambda kv: (-kv[1], kv[0]))[:top_n]
        assert [(r.value, r.row_count) for r in best.collect()] == expected


def test_skew_of_no_rows(spark):
    assert skew.skew_stats(skew.value_counts(spark.createDataFrame([], "a int, b string"))).count() == 0
