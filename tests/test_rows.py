"""Typing, audits, duplicates and quality rules on literal rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from orderlake.contracts import LINE_RULES, LINE_SIGNATURE, LINE_TYPES, ORDER_SIGNATURE, ORDER_TYPES
from orderlake.operators import audit, duplicates, quality, standardize
from samples import LINE, ORDER, lines, orders, text_frame, values

NOW = "2026-06-01 00:00:00"


# --- typing -------------------------------------------------------------------------

def test_text_that_does_not_parse_becomes_null(spark):
    raw = text_frame(spark, ORDER, [dict(order_date="not_a_date", quantity="3.0", unit_price="abc"),
                                    dict(quantity="", unit_price="7")])
    typed = standardize.conform(raw, ORDER_TYPES)
    assert values(typed, "order_date", "quantity", "unit_price") == sorted([
        (None, None, None), (date(2026, 1, 5), None, Decimal("7.00"))], key=repr)


def test_missing_column_fails_before_running(spark):
    with pytest.raises(AnalysisException):
        standardize.conform(text_frame(spark, ORDER, [{}]).drop("status"), ORDER_TYPES)


def test_trim_takes_spaces_only(spark):
    raw = text_frame(spark, LINE, [dict(status="  SHIPPED ", region="\tASIA", quantity=None)])
    row = standardize.trim_text(raw).first()
    assert (row.status, row.region, row.quantity) == ("SHIPPED", "\tASIA", None)


def test_lineage_columns(spark):
    row = standardize.stamp_orders(text_frame(spark, {"order_id": "O1"}, [{}]), "2026-06-01 08:30:00",
                                   F.lit("f.csv")).first()
    assert (row.ingest_date, row.source_filename, row.ingest_at) == (
        date(2026, 6, 1), "f.csv", datetime(2026, 6, 1, 8, 30))


# --- audits --------------------------------------------------------------------------

def test_audits_count_each_column(spark):
    raw = text_frame(spark, LINE, [dict(status=" PLACED"), dict(quantity="0", region=None), dict(unit_price="-1")])
    typed = standardize.conform(standardize.trim_text(raw), LINE_TYPES)
    assert audit.whitespace_counts(raw).first().asDict()["status"] == 1
    assert audit.null_counts(typed).first().asDict()["region"] == 1
    positive = audit.nonpositive_counts(typed).first().asDict()
    assert positive == {"quantity": 1, "unit_price": 1, "line_item_seq": 0}
    report = {(r.audit, r.column_name): r.row_count for r in audit.batch_report(raw, LINE_TYPES).collect()}
    assert report[("whitespace", "status")] == report[("null", "region")] == report[("nonpositive", "quantity")] == 1
    assert ("nonpositive", "status") not in report


def test_audit_of_no_rows_is_zero(spark):
    empty = orders(spark, {}).where("false")
    assert set(audit.null_counts(empty).first()) == {0}


def test_small_audits(spark):
    rows = orders(spark, dict(quantity="0"), dict(quantity=None), dict(order_id="O2"))
    assert audit.nonpositive_rows(rows, "quantity").count() == 1
    assert values(audit.repeated_keys(rows, ["order_id"])) == [("O1", 2)]
    assert audit.versions_of(rows, "order_id", "O2").count() == 1
    assert values(audit.layer_counts({"a": rows, "b": rows.where("false")})) == [("a", 3), ("b", 0)]


# --- copies and conflicts --------------------------------------------------------------

def flags(spark, *changes):
    flagged = duplicates.flag_orders(orders(spark, *changes), "order_id", ORDER_SIGNATURE)
    return values(flagged, "order_id", "is_conflicting", "is_invalid_quantity", "is_invalid_date")


def test_exact_copies_do_not_conflict_but_any_difference_does(spark):
    assert flags(spark, {}, {}, dict(order_id="O2"), dict(order_id="O2", product_id="P2")) == [
        ("O1", False, False, False)] * 2 + [("O2", True, False, False)] * 2


def test_raw_text_is_compared_and_null_is_a_value(spark):
    assert flags(spark, dict(status="Placed"), dict(status="placed"))[0][1] is True
    assert flags(spark, dict(payment_method=None), dict(payment_method=None))[0][1] is False
    assert flags(spark, dict(payment_method=None), {})[0][1] is True


def test_rows_without_key_never_conflict(spark):
    assert [f[1] for f in flags(spark, dict(order_id=None), dict(order_id=None, product_id="P2"))] == [False, False]


def test_conflict_statistics(spark):
    found = duplicates.conflicting_keys(orders(spark, {}, {}, dict(product_id="P2"), dict(order_id="O9")),
                                        "order_id", ORDER_SIGNATURE)
    assert values(found) == [("O1", 3, 2)]


def test_copy_check_ignores_line_number_and_fails_rows_with_gaps(spark):
    rows = lines(spark, {}, dict(line_item_seq="2"), dict(order_id="2"), dict(order_id="3", region=None))
    flagged = duplicates.flag_copies(rows, LINE_SIGNATURE)
    assert values(flagged, "order_id", "line_item_seq", "has_one_copy") == [
        ("1", 1, False), ("1", 2, False), ("2", 1, True), ("3", 1, False)]


def test_hash_narrowing_keeps_every_repeated_signature(spark):
    rows = lines(spark, {}, {}, dict(order_id="2"), dict(order_id="3"), dict(order_id="3", line_item_seq="9"))
    suspects = duplicates.suspect_hashes(rows, LINE_SIGNATURE)
    narrowed = duplicates.narrow_to_suspects(rows, LINE_SIGNATURE, suspects)
    assert values(duplicates.repeated_signatures(narrowed, LINE_SIGNATURE), "order_id", "copies") == [("1", 2), ("3", 2)]


def test_colliding_hashes_are_not_taken_for_copies(spark):
    rows = lines(spark, {}, dict(order_id="2"), dict(order_id="3"), dict(order_id="3"))
    everything = rows.select(F.xxhash64(*LINE_SIGNATURE).alias("signature_hash")).distinct()
    narrowed = duplicates.narrow_to_suspects(rows, LINE_SIGNATURE, everything)
    assert values(duplicates.repeated_signatures(narrowed, LINE_SIGNATURE), "order_id") == [("3",)]


# --- rules --------------------------------------------------------------------------------

@pytest.mark.parametrize("change, broken", [
    ({}, []),
    (dict(order_id=None), ["order_id_not_null", "row_signature_count_equals_1"]),
    (dict(customer_id=None), ["customer_id_not_null", "row_signature_count_equals_1"]),
    (dict(product_id=None), ["product_id_not_null", "row_signature_count_equals_1"]),
    (dict(quantity="0"), ["quantity_greater_than_zero_&_not_null"]),
    (dict(quantity=None), ["quantity_greater_than_zero_&_not_null", "row_signature_count_equals_1"]),
    (dict(unit_price="-1"), ["unit_price_greater_than_zero_&_not_null"]),
    (dict(region=None), ["region_not_null", "row_signature_count_equals_1"]),
    (dict(status="shipped"), ["status_valid"]),
    (dict(status=None), ["status_valid", "row_signature_count_equals_1"]),
    (dict(order_date="soon"), ["order_date_not_null", "row_signature_count_equals_1"]),
])
def test_rules_name_what_fails_in_order(spark, change, broken):
    checked = quality.check_rows(lines(spark, change), LINE_RULES, LINE_SIGNATURE)
    assert checked.first()["_failed_rules"] == broken


def test_both_copies_are_quarantined_and_the_split_loses_nothing(spark):
    rows = lines(spark, {}, dict(line_item_seq="2"), dict(order_id="2"), dict(order_id="3", quantity="0"))
    checked = quality.check_rows(rows, LINE_RULES, LINE_SIGNATURE)
    good, bad = quality.passed(checked), quality.failed(checked, NOW)
    assert values(good, "order_id") == [("2",)]
    assert values(bad, "order_id") == [("1",), ("1",), ("3",)]
    assert good.columns == rows.columns
    assert bad.columns == rows.columns + ["_failed_rules", "_quarantined_at"]
    assert values(quality.rule_failures(checked)) == [
        ("quantity_greater_than_zero_&_not_null", 1), ("row_signature_count_equals_1", 2)]


@pytest.mark.parametrize("change, reason", [
    (dict(quantity="0", order_date="x"), "conflicting_order_id+invalid_quantity+invalid_date"),
    (dict(quantity=None), "conflicting_order_id+invalid_quantity"),
    (dict(order_date="x"), "conflicting_order_id+invalid_date"),
    (dict(product_id="P2"), "conflicting_order_id"),
    (dict(order_id="O2", quantity="-1", order_date="x"), "invalid_quantity+invalid_date"),
    (dict(order_id="O2", quantity="-1"), "invalid_quantity"),
    (dict(order_id="O2", order_date="x"), "invalid_date"),
    (dict(order_id=None), "null_order_id"),
])
def test_quarantine_reasons(spark, change, reason):
    flagged = duplicates.flag_orders(orders(spark, {}, change), "order_id", ORDER_SIGNATURE)
    assert reason in [r.quarantine_reason for r in quality.quarantined_orders(flagged, NOW).collect()]


def test_cleaning_folds_copies_and_standardises(spark):
    rows = orders(spark, dict(status=" Shipped ", payment_method=None, source_filename="b.csv"),
                  dict(status=" Shipped ", payment_method=None, source_filename="a.csv"),
                  dict(order_id="O2", payment_method=" PayPal"), dict(order_id="O3", unit_price=None))
    flagged = duplicates.flag_orders(rows, "order_id", ORDER_SIGNATURE)
    clean = quality.clean_orders(flagged, ORDER_SIGNATURE)
    assert values(clean, "order_id", "status", "payment_method", "source_filename") == [
        ("O1", "shipped", "unknown", "a.csv"), ("O2", "placed", "paypal", "a.csv")]
    assert values(quality.unpriced_orders(flagged), "order_id") == [("O3",)]
    assert quality.quarantined_orders(flagged, NOW).count() == 0
