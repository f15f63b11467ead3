"""Both pipelines from files to tables, reruns and corrections included."""

import glob
import os
from datetime import date, datetime
from decimal import Decimal

import pytest

from orderlake.contracts import LINE_RAW, ORDER_RAW, PROGRESSED, UNCHANGED, NEW_ORDER
from orderlake.plans.lines import LineLake
from orderlake.plans.orders import OrderLake
from samples import LINE, ORDER, values, write_csv

D1, D2, D3 = (f"2026-06-0{n} 00:00:00" for n in (1, 2, 3))


def order_file(path, *changes):
    return write_csv(path, ORDER_RAW, [{**ORDER, **c} for c in changes])


def line_file(path, *changes):
    return write_csv(path, LINE_RAW, [{**LINE, **c} for c in changes])


def counts(lake):
    return {r.layer: r.row_count for r in lake.row_counts().collect()}


FIRST = [{}, {}, dict(order_id="O2", status=" Placed "), dict(order_id="O3", quantity="0"),
         dict(order_id="O4", order_date="not_a_date"), dict(order_id="O5", unit_price=None),
         dict(order_id="O6"), dict(order_id="O6", product_id="P2"), dict(order_id="O7", payment_method=None),
         dict(order_id=None)]
SECOND = [dict(status="shipped"), dict(order_id="O2", status="placed"), dict(order_id="O8")]


def test_single_batch_orders(spark, tmp_path):
    lake = OrderLake(spark, str(tmp_path / "lake"))
    lake.run(order_file(tmp_path / "d1.csv", *FIRST), D1)
    assert counts(lake) == {"bronze": 10, "quarantine": 5, "silver": 3, "daily_revenue": 1, "status_counts": 1}
    assert values(lake.quarantine.read(), "order_id", "quarantine_reason") == sorted([
        ("O3", "invalid_quantity"), ("O4", "invalid_date"), ("O6", "conflicting_order_id"),
        ("O6", "conflicting_order_id"), (None, "null_order_id")], key=repr)
    assert values(lake.daily_revenue.read()) == [(date(2026, 1, 5), "P1", Decimal("63.00"))]
    assert values(lake.status_counts.read()) == [("placed", 3)]
    nulls = {r.column_name: r.row_count for r in lake.audit(D1).where("audit = 'null'").collect()}
    assert (nulls["order_id"], nulls["unit_price"], nulls["order_date"]) == (1, 1, 1)

    lake.run(order_file(tmp_path / "d2.csv", *SECOND), D2)
    assert values(lake.silver.read(), "order_id", "status") == [
        ("O1", "shipped"), ("O2", "placed"), ("O7", "placed"), ("O8", "placed")]
    operations = values(lake.history_log().where("table_name = 'silver/orders'"), "operation", "row_count")
    assert operations == [("append", 3), ("upsert", 4)]


def test_order_history_with_manifest_and_rerun(spark, tmp_path):
    lake = OrderLake(spark, str(tmp_path / "lake"), keep_history=True)
    second = order_file(tmp_path / "d2.csv", *SECOND)
    lake.run(order_file(tmp_path / "d1.csv", *FIRST), D1)
    lake.run(second, D2)
    version = ("order_id", "status", "is_current", "valid_from", "valid_to")
    expected = sorted([
        ("O1", "placed", False, date(2026, 6, 1), datetime(2026, 6, 2)),
        ("O1", "shipped", True, date(2026, 6, 2), None), ("O2", "placed", True, date(2026, 6, 1), None),
        ("O7", "placed", True, date(2026, 6, 1), None), ("O8", "placed", True, date(2026, 6, 2), None)], key=repr)
    assert values(lake.silver.read(), *version) == expected
    assert values(lake.change_log.read(), "order_id", "status") == [("O1", "placed"), ("O1", "shipped")]
    manifest = write_csv(tmp_path / "m.csv", ["order_id", "expected_category"], [
        dict(order_id="O1", expected_category=PROGRESSED), dict(order_id="O2", expected_category=UNCHANGED),
        dict(order_id="O8", expected_category=NEW_ORDER)])
    checks = lake.reconcile(manifest)
    assert checks["summary"].first().is_match is True
    assert all(checks[name].count() == 0 for name in ("missing", "unexpected", "wrongly_versioned", "version_mismatches"))

    before = counts(lake)
    lake.run(second, D2)
    assert counts(lake) == before
    assert values(lake.silver.read(), *version) == expected


def test_upsert_by_partition(spark, tmp_path):
    lake = OrderLake(spark, str(tmp_path / "lake"))
    day = lambda order, date, **more: dict(order_id=order, order_date=date, **more)
    lake.run(order_file(tmp_path / "d1.csv", day("O1", "2026-01-05"), day("O2", "2026-01-05"),
                        day("O3", "2026-02-06"), day("O4", "2026-03-07")), D1)
    first = lake.silver.location()
    # one order leaves a month that keeps another: three months are rewritten in place
    lake.run(order_file(tmp_path / "d2.csv", day("O2", "2026-04-08"), day("O3", "2026-02-06", quantity="9")), D2)
    assert lake.silver.location() == first
    assert values(lake.silver.read(), "order_id", "order_date", "quantity") == [
        ("O1", date(2026, 1, 5), 2), ("O2", date(2026, 4, 8), 2), ("O3", date(2026, 2, 6), 9), ("O4", date(2026, 3, 7), 2)]
    # the last order of a month moves: its old row must not stay behind, the other months stay as they are
    untouched = {p: os.path.getmtime(p) for p in glob.glob(f"{first}/order_month=2026-0[24]/*.parquet")}
    lake.run(order_file(tmp_path / "d3.csv", day("O4", "2026-01-05")), D3)
    assert lake.silver.location() == first and not os.path.exists(f"{first}/order_month=2026-03")
    assert untouched and {p: os.path.getmtime(p) for p in untouched} == untouched
    assert values(lake.silver.read(), "order_id", "order_date") == [
        ("O1", date(2026, 1, 5)), ("O2", date(2026, 4, 8)), ("O3", date(2026, 2, 6)), ("O4", date(2026, 1, 5))]


def test_repeated_line_key_stops_the_first_run(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    with pytest.raises(Exception):
        lake.run(line_file(tmp_path / "d1.csv", {}, dict(status="SHIPPED")), D1)
    assert not lake.silver.exists()


def test_quarantine_is_kept_by_load_date_in_few_files(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    bad = lambda day: [dict(order_id=str(i), quantity="-1", order_date=f"2026-01-{i % 28 + 1:02d}", ingest_date=day)
                       for i in range(60)]
    lake.run(line_file(tmp_path / "d1.csv", *bad("2026-06-01")), D1)
    first = {p: os.path.getmtime(p) for p in glob.glob(f"{lake.quarantine.location()}/*/*.parquet")}
    assert 1 <= len(first) <= 2
    second = line_file(tmp_path / "d2.csv", *bad("2026-06-02"))
    for _ in range(2):
        lake.run(second, D2)
        assert {p: os.path.getmtime(p) for p in first} == first
        assert lake.quarantine.read().count() == 120


DAY1 = [{}, dict(line_item_seq="2", quantity=" 3 "), dict(order_id="2", status="SHIPPED"),
        dict(order_id="3"), dict(order_id="3", line_item_seq="9"), dict(order_id="4", region=None),
        dict(order_id="5", order_date="2026-03-06")]
DAY2 = [dict(status="PROCESSING"), dict(line_item_seq="2", quantity=" 3 "), dict(order_id="6", order_date="2026-01-07"),
        dict(order_id="7", quantity="-1")]
DAY2 = [{**row, "ingest_date": "2026-06-02"} for row in DAY2]


def test_line_pipeline(spark, tmp_path):
    for name in ("lake",):
        lake = LineLake(spark, str(tmp_path / name))
        lake.run(line_file(tmp_path / "d1.csv", *DAY1), D1)
        second = line_file(tmp_path / "d2.csv", *DAY2)
        for _ in range(2):  # the second delivery arrives twice
            lake.run(second, D2)
            assert counts(lake) == {"bronze": 11, "quarantine": 4, "silver": 6, "order_summary": 4, "region_daily": 3}
            assert values(lake.silver.read(), "order_id", "line_item_seq", "status", "is_current") == [
                ("1", 1, "PLACED", False), ("1", 1, "PROCESSING", True), ("1", 2, "PLACED", True),
                ("2", 1, "SHIPPED", True), ("5", 1, "PLACED", True), ("6", 1, "PLACED", True)]
            assert values(lake.order_summary.read(), "order_id", "line_item_count", "total_order_value", "status") == [
                ("1", 2, Decimal("52.50"), "PLACED"), ("2", 1, Decimal("21.00"), "SHIPPED"),
                ("5", 1, Decimal("21.00"), "PLACED"), ("6", 1, Decimal("21.00"), "PLACED")]
        stats, top = lake.skew(["order_id"], top_n=1)
        assert values(stats, "max_count", "distinct_keys") == [(3, 4)]
        assert values(top, "value", "row_count") == [("1", 3)]
        lines, rolled = lake.order_check("1")
        assert values(lines) == [("PLACED", 1), ("PROCESSING", 1)] and rolled.first().status == "PLACED"
        assert {r.table_name for r in lake.health().collect()} == set(counts(lake))


def test_a_run_leaves_nothing_written_aside(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    folder = lake.stage.folder
    lake.run(line_file(tmp_path / "d1.csv", *DAY1), D1)
    assert lake.stage.folder != folder and not os.path.exists(folder)


def test_history_rewrites_only_the_partitions_that_changed(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.run(line_file(tmp_path / "d1.csv", *DAY1), D1)
    files = {r.path: r.modificationTime for r in _listing(spark, lake)}
    lake.run(line_file(tmp_path / "d2.csv", *DAY2), D2)
    later = {r.path: r.modificationTime for r in _listing(spark, lake)}
    kept = [p for p in files if "order_month=2026-03" in p]
    assert kept and all(later[p] == files[p] for p in kept)
    assert not [p for p in files if "order_date=2026-01-05" in p and p in later]


def _listing(spark, lake):
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .load(lake.silver.location()).select("path", "modificationTime").collect())


def test_version_that_moves_to_another_day_leaves_its_closed_one_behind(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.run(line_file(tmp_path / "d1.csv", dict(order_id="5", order_date="2026-01-06")), D1)
    lake.run(line_file(tmp_path / "d2.csv", dict(order_id="5", order_date="2026-01-09", status="SHIPPED",
                                                 ingest_date="2026-06-02")), D2)
    assert values(lake.silver.read(), "order_date", "status", "is_current") == [
        (date(2026, 1, 6), "PLACED", False), (date(2026, 1, 9), "SHIPPED", True)]


def test_late_correction_replaces_only_its_orders_of_that_load_date(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.ingest(line_file(tmp_path / "d1.csv", *DAY1, dict(order_id="8", ingest_date=None)), D1)
    lake.ingest(line_file(tmp_path / "d2.csv", *DAY2), D2)
    lake.ingest(line_file(tmp_path / "fix.csv", dict(quantity="7"), dict(order_id="9", ingest_date=None)), D3)
    assert values(lake.bronze.read(), "order_id", "ingest_date", "_source_file").count(("1", "2026-06-01", "d1.csv")) == 0
    kept = values(lake.bronze.read(), "order_id", "ingest_date", "quantity")
    assert ("1", "2026-06-01", "7") in kept and ("1", "2026-06-02", "2") in kept
    assert ("8", None, "2") in kept and ("9", None, "2") in kept
    assert len(kept) == 8 + 4 - 2 + 2
    assert lake.delivered(D3).count() == 2


def test_a_delivery_without_good_rows_still_reports(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.run(line_file(tmp_path / "d1.csv", dict(quantity="0")), D1)
    assert lake.silver.read().count() == 0 and lake.order_summary.read().count() == 0
    lake.run(line_file(tmp_path / "d2.csv", *DAY2), D2)
    assert lake.order_summary.read().count() == 2
