"""What batches leave behind: new columns, corrections, partial refreshes, ledgers."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from orderlake.contracts import LINE_RAW, ORDER_RAW
from orderlake.operators import gold, layout
from orderlake.plans.lines import LineLake
from orderlake.plans.orders import OrderLake
from orderlake.sources.raw import file_name, new_columns, read_delivery
from orderlake.sources.tables import LakeTable
from samples import LINE, ORDER, values, write_csv

D1, D2, D3 = (f"2026-06-0{n} 00:00:00" for n in (1, 2, 3))


def lines(path, *changes, header=LINE_RAW):
    return write_csv(path, header, [{**LINE, **c} for c in changes])


def orders(path, *changes, header=ORDER_RAW):
    return write_csv(path, header, [{**ORDER, **c} for c in changes])


def stamps(table):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{table.location()}/*/*.parquet")}


# --- columns beyond the contract ------------------------------------------------

def test_new_columns_reach_bronze_quarantine_and_silver(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.run(lines(tmp_path / "d1.csv", {}, dict(order_id="2", quantity="0")), D1)
    wider = [*LINE_RAW[:3], "channel", *LINE_RAW[3:], "Note"]
    day2 = dict(ingest_date="2026-06-02")
    files = [lines(tmp_path / "d2.csv", dict(order_id="3", channel=" web ", Note="n", **day2),
                   dict(order_id="4", channel="shop", Note=None, quantity="-1", **day2), header=wider),
             lines(tmp_path / "d2b.csv", dict(order_id="5", **day2))]
    lake.run(files, D2)
    # a new object on the same folder knows the columns, and another spelling is the same column
    lake = LineLake(spark, str(tmp_path / "lake"))
    assert lake.extra == ["channel", "Note"]
    lake.run(lines(tmp_path / "d3.csv", dict(order_id="6", CHANNEL="app", ingest_date="2026-06-03"),
                   header=[*LINE_RAW, "CHANNEL"]), D3)
    found = values(lake.bronze.read(), "order_id", "channel", "Note")
    assert found == sorted([("1", None, None), ("2", None, None), ("3", " web ", "n"), ("4", "shop", None),
                            ("5", None, None), ("6", "app", None)], key=repr)
    assert values(lake.quarantine.read(), "order_id", "channel") == [("2", None), ("4", "shop")]
    assert values(lake.silver.read(), "order_id", "channel") == sorted(
        [("1", None), ("3", "web"), ("5", None), ("6", "app")], key=repr)
    assert lake.order_summary.read().count() == 4


def test_new_order_columns_follow_the_history(spark, tmp_path):
    lake = OrderLake(spark, str(tmp_path / "lake"), keep_history=True)
    lake.run(orders(tmp_path / "d1.csv", {}, dict(order_id="O2")), D1)
    lake.run(orders(tmp_path / "d2.csv", dict(status="shipped", channel="web"), header=[*ORDER_RAW, "channel"]), D2)
    assert values(lake.silver.read(), "order_id", "status", "channel") == sorted(
        [("O1", "placed", None), ("O1", "shipped", "web"), ("O2", "placed", None)], key=repr)
    assert values(lake.change_log.read(), "status", "channel") == [("placed", None), ("shipped", "web")]


def test_headers_that_break_the_contract_stop_the_delivery(spark, tmp_path):
    for header, message in ((LINE_RAW[1:], "lacks"), ([*LINE_RAW[1:], LINE_RAW[0]], "another order"),
                            ([*LINE_RAW, "_source_file"], "reserved"), ([*LINE_RAW, "Valid_To"], "reserved")):
        bad = write_csv(tmp_path / "bad.csv", header, [{**LINE, "Valid_To": "x"}])
        lake = LineLake(spark, str(tmp_path / "lake"))
        with pytest.raises(ValueError, match=message):
            lake.run([lines(tmp_path / "good.csv", {}), bad], D1)
        assert not lake.bronze.exists()
    assert new_columns(["B", "x", "a"], ["b", "A"], []) == ["x"]


def test_files_with_one_header_are_one_scan(spark, tmp_path):
    for i in range(6):
        header = [*LINE_RAW, "channel"] if i % 2 else LINE_RAW
        write_csv(tmp_path / f"part {i}.csv", header, [{**LINE, "channel": str(i)}])
    (tmp_path / "nothing.csv").write_text("")
    rows, found = read_delivery(spark, str(tmp_path), LINE_RAW, file_name(), "_source_file", [])
    assert found == ["channel"]
    assert values(rows, "channel", "_source_file")[:3] == [
        ("1", "part%201.csv"), ("3", "part%203.csv"), ("5", "part%205.csv")]
    assert rows.count() == 6
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2


# --- corrections and reruns -----------------------------------------------------

def test_a_corrected_batch_takes_its_rows_out_of_quarantine(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    other = dict(order_id="9", quantity="0", ingest_date="2026-05-31")
    lake.run(lines(tmp_path / "d0.csv", other), "2026-05-31 00:00:00")
    lake.run(lines(tmp_path / "d1.csv", dict(quantity="0"), dict(order_id="2", quantity="0", ingest_date="2026-05-31")), D1)
    assert values(lake.quarantine.read(), "order_id") == [("1",), ("2",), ("9",)]
    # the mended rows bring nothing to either load date any more
    lake.run(lines(tmp_path / "d1.csv", {}, dict(order_id="2", ingest_date="2026-05-31")), D1)
    assert values(lake.quarantine.read(), "order_id") == [("9",)]
    assert values(lake.silver.read(), "order_id") == [("1",), ("2",)]
    assert not os.path.exists(f"{lake.quarantine.location()}/ingest_date=2026-06-01")


def test_a_price_that_its_type_cannot_hold_says_so(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    prices = {"1": "123456789012345.00", "2": "0.00000049", "3": "-1e20", "4": "0", "5": "0.000", "6": "ten", "7": None,
              "8": "99999999999999.999999", "9": "0.000001", "10": " 1e3 "}
    lake.run(lines(tmp_path / "d1.csv", *[dict(order_id=k, unit_price=v) for k, v in prices.items()]), D1)
    # a price that became NULL fails the copy rule as well, like every row with a NULL business value
    positive, copies, fits = "unit_price_greater_than_zero_&_not_null", "row_signature_count_equals_1", "unit_price_fits"
    assert values(lake.quarantine.read(), "order_id", "_failed_rules") == [
        ("1", [positive, copies, fits]), ("2", [positive, fits]), ("3", [positive, copies, fits]),
        ("4", [positive]), ("5", [positive]), ("6", [positive, copies]), ("7", [positive, copies])]
    assert sorted(r.order_id for r in lake.silver.read().collect()) == ["10", "8", "9"]
    assert "price_fits" not in lake.quarantine.read().columns + lake.silver.read().columns


def test_a_corrected_order_batch_takes_its_rows_out_of_quarantine(spark, tmp_path):
    lake = OrderLake(spark, str(tmp_path / "lake"))
    file = orders(tmp_path / "d1.csv", dict(quantity="0"), dict(order_id="O2"))
    lake.run(file, D1)
    assert values(lake.quarantine.read(), "order_id") == [("O1",)]
    lake.run(orders(tmp_path / "d1.csv", {}, dict(order_id="O2")), D1)
    assert lake.quarantine.read().count() == 0
    assert values(lake.silver.read(), "order_id") == [("O1",), ("O2",)]
    assert values(lake.bronze.read(), "order_id", "quantity") == [("O1", "2"), ("O2", "2")]


def test_lines_without_a_key_or_load_date_survive_a_rerun_unchanged(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.run(lines(tmp_path / "d0.csv", dict(order_id="8")), D1)
    file = lines(tmp_path / "d1.csv", dict(line_item_seq="x"), dict(order_id=None), dict(order_id="3", ingest_date="soon"),
                 dict(order_id="4", line_item_seq="2", ingest_date=" 2026-06-02 "))
    for _ in range(2):
        lake.run(file, D2)
        assert values(lake.bronze.read(), "order_id", "ingest_date") == sorted(
            [("8", "2026-06-01"), ("1", "2026-06-01"), (None, "2026-06-01"), ("3", None), ("4", "2026-06-02")], key=repr)
        assert ("1", ["line_item_seq_not_null"]) in values(lake.quarantine.read(), "order_id", "_failed_rules")
        assert lake.quarantine.read().count() == 2
        assert values(lake.order_summary.read(), "order_id", "line_item_count") == [("3", 1), ("4", 1), ("8", 1)]


# --- partial refreshes ------------------------------------------------------------

def months(*pairs):
    return [dict(order_id=k, order_date=d) for k, d in pairs]


def test_only_changed_months_of_gold_are_written(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.run(lines(tmp_path / "d1.csv", *months(("1", "2026-01-05"), ("2", "2026-02-05"), ("3", "2026-03-05"))), D1)
    before, place = stamps(lake.order_summary), lake.order_summary.location()
    moved = [dict(order_id="1", order_date="2026-04-05", status="SHIPPED", ingest_date="2026-06-02"),
             dict(order_id="3", order_date="2026-03-05", status="SHIPPED", ingest_date="2026-06-02")]
    lake.run(lines(tmp_path / "d2.csv", *moved), D2)
    after = stamps(lake.order_summary)
    assert lake.order_summary.location() == place
    kept = [p for p in before if "order_month=2026-02" in p]
    assert kept and all(after.get(p) == before[p] for p in kept)
    # the only order of January closed, so its month leaves the summary and the regions
    assert values(lake.order_summary.read(), "order_id", "order_month", "status") == [
        ("1", "2026-04", "SHIPPED"), ("2", "2026-02", "PLACED"), ("3", "2026-03", "SHIPPED")]
    whole = gold.region_daily(gold.order_summary(lake.silver.read()))
    assert values(lake.region_daily.read(), *whole.columns) == values(whole)
    assert not os.path.exists(f"{place}/order_month=2026-01")


def test_a_run_that_died_before_its_reports_is_made_up_for(spark, tmp_path, monkeypatch):
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.run(lines(tmp_path / "d1.csv", *months(("1", "2026-01-05"))), D1)
    with monkeypatch.context() as patch:
        patch.setattr(lake, "report", lambda as_of: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.run(lines(tmp_path / "d2.csv", dict(order_date="2026-02-06", order_id="2", ingest_date="2026-06-02")), D2)
    assert values(lake.order_summary.read(), "order_id") == [("1",)]
    lake.run(lines(tmp_path / "d3.csv", dict(order_date="2026-03-06", order_id="3", ingest_date="2026-06-03")), D3)
    assert values(lake.order_summary.read(), "order_id") == [("1",), ("2",), ("3",)]
    assert lake.region_daily.read().count() == 3


def test_change_log_is_refreshed_where_versions_changed(spark, tmp_path):
    lake = OrderLake(spark, str(tmp_path / "lake"), keep_history=True)
    statuses = [("placed", "placed", "placed"), ("shipped", "placed", "placed"), ("shipped", "placed", "cancelled"),
                ("delivered", "placed", "cancelled")]
    for n, batch in enumerate(statuses, 1):
        rows = [dict(order_id=f"O{k}", status=status) for k, status in enumerate(batch)]
        lake.run(orders(tmp_path / f"d{n}.csv", *rows, dict(order_id=f"N{n}")), f"2026-06-0{n} 00:00:00")
        whole = gold.status_change_log(lake.silver.read())
        assert values(lake.change_log.read(), *whole.columns) == values(whole)
    assert values(lake.change_log.read(), "order_id", "status", "is_current") == [
        ("O0", "delivered", True), ("O0", "placed", False), ("O0", "shipped", False),
        ("O2", "cancelled", True), ("O2", "placed", False)]
    # the last batch touched the second and fourth load dates only
    stamped = {r.ingest_date: r.gold_at.day for r in lake.change_log.read().collect()}
    assert stamped == {date(2026, 6, 1): 3, date(2026, 6, 2): 4, date(2026, 6, 3): 3, date(2026, 6, 4): 4}
    assert values(lake.reconcile(write_csv(tmp_path / "m.csv", ["order_id", "expected_category"], []))["version_mismatches"]) \
        == [("O0", 3)]


def test_daily_revenue_follows_orders_that_change_their_month(spark, tmp_path):
    lake = OrderLake(spark, str(tmp_path / "lake"))
    lake.run(orders(tmp_path / "d1.csv", *months(("O1", "2026-01-05"), ("O2", "2026-02-05"), ("O3", "2026-02-05"))), D1)
    lake.run(orders(tmp_path / "d2.csv", *months(("O1", "2026-03-05"), ("O3", "2026-02-06"))), D2)
    whole = gold.daily_revenue(lake.silver.read())
    assert values(lake.daily_revenue.read()) == values(whole) and whole.count() == 3


# --- ledgers ------------------------------------------------------------------------

def test_new_files_are_landed_without_a_look_at_older_rows(spark, tmp_path, monkeypatch):
    lake = OrderLake(spark, str(tmp_path / "lake"))
    first = orders(tmp_path / "d 1.csv", {}, dict(order_id="O2"))
    lake.ingest(first, D1)
    with monkeypatch.context() as patch:
        patch.setattr(lake.bronze, "read", lambda: 1 / 0)
        lake.ingest(orders(tmp_path / "d2.csv", dict(order_id="O3")), D2)
        with pytest.raises(ZeroDivisionError):
            lake.ingest(first, D3)
    lake.ingest(first, D3)
    assert values(lake.bronze.read(), "order_id", "ingest_date") == [
        ("O1", date(2026, 6, 3)), ("O2", date(2026, 6, 3)), ("O3", date(2026, 6, 2))]
    noted = lake.files.table.read()
    assert values(noted, "file_path", "file_size") == sorted(
        (f"file:{tmp_path}/{n}", os.path.getsize(tmp_path / n)) for n in ("d 1.csv", "d2.csv"))


def test_every_stage_of_a_run_is_timed(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.run(lines(tmp_path / "d1.csv", {}), D1)
    times = lake.stages.read().collect()
    assert [t.stage for t in sorted(times, key=lambda t: t.started_at)] == ["bronze", "quality", "merge", "gold"]
    assert all(t.seconds >= 0 and t.ended_at >= t.started_at for t in times)


def test_health_from_rows_agrees_with_the_listing(spark, tmp_path):
    table = LakeTable(spark, str(tmp_path / "t"))
    table.publish(spark.range(1000).repartition(3).toDF("v"))
    empty = LakeTable(spark, str(tmp_path / "e"))
    empty.publish(spark.range(0).toDF("v"))
    health = {r.table_name: r for r in layout.stored_health({"t": table.read(), "e": empty.read()}).collect()}
    listed = layout.table_health(spark, {"t": table.location()}).first()
    assert (health["t"].row_count, health["t"].file_count, health["t"].size_bytes) == (1000, 3, listed.size_bytes)
    assert (health["e"].row_count, health["e"].file_count, health["e"].size_bytes) == (0, 0, 0)


def test_partitions_with_odd_names_are_dropped(spark, tmp_path):
    table = LakeTable(spark, str(tmp_path / "t"), partition_by=("d",))
    odd = ["a/b", "c:d", "50%", "x=y", None, "plain"]
    table.publish(spark.createDataFrame([(d, 1) for d in odd], "d string, v int"))
    table.drop_partitions(odd[:-1])
    assert values(table.read(), "d") == [("plain",)]
    assert table.read().where(F.col("d").isNull()).count() == 0


# --- sizes of layers ------------------------------------------------------------------

def test_layer_sizes_are_counted_by_the_writes(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lines"))
    lake.run(lines(tmp_path / "l1.csv", {}, dict(order_id="2", quantity="0"), dict(order_id=None, region=None)), D1)
    sizes = dict(values(lake.layers.read(), "layer", "row_count"))
    assert [sizes[n] for n in ("landed", "quarantined", "passed")] == [3, 2, 1]
    assert {n: c for n, c in sizes.items() if c and n not in ("landed", "quarantined", "passed")} == {
        "quantity_greater_than_zero_&_not_null": 1, "order_id_not_null": 1, "region_not_null": 1,
        "row_signature_count_equals_1": 1}
    lake = OrderLake(spark, str(tmp_path / "orders"))
    lake.run(orders(tmp_path / "o1.csv", {}, {}, dict(order_id="O2", quantity="0"), dict(order_id=None),
                    dict(order_id="O3", unit_price=None)), D1)
    lake.run(orders(tmp_path / "o2.csv"), D2)
    assert sorted(map(tuple, lake.layers.read().select("batch", "layer", "row_count").collect())) == sorted(
        [(lake.log.read().agg(F.min("run_at")).first()[0], n, c) for n, c in
         dict(raw=5, quarantine=2, unpriced=1, priced=2, clean=1).items()]
        + [(lake.log.read().agg(F.max("run_at")).first()[0], n, 0) for n in
           ("raw", "quarantine", "unpriced", "priced", "clean")])
