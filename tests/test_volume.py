"""What a line delivery shuffles and writes more than once, and what it does not."""

import glob
import os

import pyarrow.parquet as pq

from orderlake.contracts import LINE_SIGNATURE
from orderlake.operators import duplicates
from orderlake.operators.plan import plan_text
from orderlake.plans import catalog, deliveries
from orderlake.plans.lines import LineLake
from orderlake.sources.tables import LakeTable, Stage
from samples import lines, values
from test_copies import no_broadcast  # noqa: F401
from test_pipelines import D1, D2, DAY1, line_file


def test_orders_get_their_regions_before_they_meet_their_lines(spark, tmp_path, no_broadcast):  # noqa: F811
    for name, ddl in {"lineitem": "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, "
                                  "l_extendedprice double, l_returnflag string, l_linestatus string",
                      "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp",
                      "customer": "c_custkey long, c_nationkey int", "nation": "n_nationkey int, n_regionkey int",
                      "region": "r_regionkey int, r_name string"}.items():
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    plan = plan_text(deliveries.raw_lines(spark, str(tmp_path), 1), mode="simple")
    assert plan.index("hashpartitioning(l_orderkey") < plan.index("hashpartitioning(o_custkey")


def test_delivered_files_are_compressed_and_keep_their_spaces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 3, raising=False)
    rows = spark.range(0, 8, 1, 1).selectExpr("cast(id AS string) AS a", "' x ' AS b")
    path = catalog.delivered(spark, rows, str(tmp_path / "day"))
    assert len(glob.glob(f"{path}/*.csv.gz")) == 3
    assert values(spark.read.option("header", True).csv(path)) == [(str(n), " x ") for n in range(8)]


def test_months_without_a_closing_version_keep_their_files(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.run(line_file(tmp_path / "d1.csv", *DAY1), D1)
    files = {p: os.path.getmtime(p) for p in glob.glob(f"{lake.silver.location()}/*/*.parquet")}
    added = [dict(order_id="8", order_date="2026-01-07"), dict(status="SHIPPED", order_id="5", order_date="2026-03-06"),
             dict(order_id="9", order_date="2026-03-08")]
    lake.run(line_file(tmp_path / "d2.csv", *[{**row, "ingest_date": "2026-06-02"} for row in added]), D2)
    kept = {p: t for p, t in files.items() if "order_month=2026-01" in p}
    assert kept and all(os.path.exists(p) and os.path.getmtime(p) == t for p, t in kept.items())
    assert values(lake.silver.read(), "order_id", "line_item_seq", "status", "is_current") == [
        ("1", 1, "PLACED", True), ("1", 2, "PLACED", True), ("2", 1, "SHIPPED", True), ("5", 1, "PLACED", False),
        ("5", 1, "SHIPPED", True), ("8", 1, "PLACED", True), ("9", 1, "PLACED", True)]
    assert [r.row_count for r in lake.history_log().collect() if r.operation == "merge history"] == [4]


def test_a_later_delivery_writes_its_keys_aside_and_not_its_rows(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    for _ in range(2):
        lake.ingest(line_file(tmp_path / "d1.csv", *DAY1), D1)
    for name in os.listdir(lake.stage.folder):
        assert "quantity" not in spark.read.parquet(f"{lake.stage.folder}/{name}").columns
    assert lake.bronze.read().count() == len(DAY1)


def test_quarantine_of_one_load_date_is_written_as_it_is_read(spark, tmp_path, monkeypatch):
    lake, seen = LineLake(spark, str(tmp_path / "lake")), []
    arranged = lake.quarantine._arranged
    monkeypatch.setattr(lake.quarantine, "_arranged", lambda rows: seen.append(rows) or arranged(rows))
    lake.run(line_file(tmp_path / "d1.csv", *DAY1), D1)
    assert lake.quarantine.read().count() == 3 and not seen


def test_layers_count_suspected_copies_once(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.run(line_file(tmp_path / "d1.csv", *DAY1), D1)
    sizes = {r.layer: r.row_count for r in lake.layers.read().collect()}
    assert (sizes["landed"], sizes["quarantined"], sizes["passed"]) == (7, 3, 4)
    assert sizes["row_signature_count_equals_1"] == 3 and sizes["region_not_null"] == 1


def test_parts_of_hashes_make_the_same_words(spark):
    rows = lines(spark, *[dict(order_id=str(n // 2)) for n in range(300)], dict(order_id="x"), dict(region=None), dict(region=None))
    words = [values(duplicates.suspect_words(find(rows, LINE_SIGNATURE)), "_word", "_bits")
             for find in (duplicates.suspect_hashes, duplicates.suspect_parts)]
    assert words[0] == words[1] and len(words[0]) > 100


def test_columns_of_many_values_give_their_dictionary_up_early(spark, tmp_path):
    rows = spark.range(0, 240_000, 1, 1).selectExpr("left(md5(cast(id div 4 AS string)), 12) AS k", "id % 3 AS v")
    stage, table = Stage(spark, str(tmp_path)), LakeTable(spark, str(tmp_path / "t"))
    table.publish(rows)
    for kept in (stage.keep(rows, "kept"), table.read()):
        [file] = kept.inputFiles()
        keys, few = (pq.ParquetFile(file.removeprefix("file://")).metadata.row_group(0).column(c) for c in (0, 1))
        assert keys.dictionary_page_offset is None or keys.data_page_offset - keys.dictionary_page_offset < 70_000
        assert few.dictionary_page_offset is not None
        assert kept.selectExpr("count(DISTINCT k)", "sum(v)").first() == (60_000, 240_000)
