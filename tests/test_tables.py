"""Files in, tables out: raw reader, snapshots, partitions, clustering, health."""

import os

import pytest
from pyspark.sql import functions as F

from orderlake.operators import layout
from orderlake.sources.raw import file_name, file_uri, read_text_columns
from orderlake.sources.runlog import RunLog
from orderlake.sources.tables import LakeTable, Stage, shared_folder
from samples import values


def frame(spark, *rows, schema="k string, d string, v int"):
    return spark.createDataFrame(list(rows), schema)


def test_raw_files_are_all_text_with_lineage(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,qty\n 1 ,\n2,x\n")
    rows = read_text_columns(spark, str(tmp_path / "a.csv"), ["id", "qty"]).withColumns(
        {"name": file_name(), "uri": file_uri()})
    assert [t for _, t in rows.dtypes[:2]] == ["string", "string"]
    assert values(rows, "id", "qty", "name") == [(" 1 ", None, "a.csv"), ("2", "x", "a.csv")]
    assert rows.first().uri.endswith("/a.csv") and ":" in rows.first().uri


def test_header_must_match_the_contract(spark, tmp_path):
    (tmp_path / "a.csv").write_text("qty,id\n5,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_text_columns(spark, str(tmp_path / "a.csv"), ["id", "qty"]).collect()
    assert read_text_columns(spark, str(tmp_path / "a.csv")).columns == ["qty", "id"]


def test_publishing_what_was_just_read_keeps_the_data(spark, tmp_path):
    table = LakeTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.publish(frame(spark, ("a", "1", 1))) == 1
    assert table.publish(table.read().withColumn("v", F.col("v") + 1)) == 1
    assert table.append(frame(spark, ("b", "1", 5))) == 1
    assert values(table.read()) == [("a", "1", 2), ("b", "1", 5)]


def test_unfinished_snapshot_is_not_read_and_gets_overwritten(spark, tmp_path):
    table = LakeTable(spark, str(tmp_path / "t"))
    table.publish(frame(spark, ("a", "1", 1)))
    frame(spark, ("half", "1", 1)).write.parquet(str(tmp_path / "t" / "snapshot=00000002"))
    os.remove(tmp_path / "t" / "snapshot=00000002" / "_SUCCESS")
    assert values(table.read(), "k") == [("a",)]
    table.publish(frame(spark, ("c", "1", 1)))
    assert values(table.read(), "k") == [("c",)]


def test_only_named_partitions_are_replaced(spark, tmp_path):
    table = LakeTable(spark, str(tmp_path / "t"), partition_by=("d",), cluster_by=("k",),
                      schema=frame(spark).schema)
    table.publish(frame(spark, ("a", "1", 1), ("b", "2", 1), ("c", None, 1)))
    part = table.read().where("d = '2'").withColumn("v", F.lit(9))
    assert table.replace_partitions(part) == 1
    assert values(table.read(), "k", "d", "v") == sorted([("a", "1", 1), ("b", "2", 9), ("c", None, 1)], key=repr)
    assert dict(table.read().dtypes)["d"] == "string"


def test_later_columns_can_be_read_back(spark, tmp_path):
    table = LakeTable(spark, str(tmp_path / "t"))
    table.append(frame(spark, ("a", "1", 1)))
    table.append(frame(spark, ("b", "1", 2, "web"), schema="k string, d string, v int, channel string"))
    assert values(table.read(evolved=True), "k", "channel") == [("a", None), ("b", "web")]


def test_clustering_splits_a_heavy_value_and_keeps_all_rows(spark, tmp_path):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                    (F.col("id") % 2).alias("v"))
    LakeTable(spark, str(tmp_path / "in")).publish(rows)
    stored = LakeTable(spark, str(tmp_path / "in")).read()
    clustered = layout.cluster_rows(stored, ["k"], files=6)
    sizes = clustered.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).orderBy("p").collect()
    assert sum(s.n for s in sizes) == 9000 and max(s.n for s in sizes) < 3000
    assert all(a.high <= b.low for a, b in zip(sizes, sizes[1:]))
    assert clustered.groupBy("k", "v").count().exceptAll(rows.groupBy("k", "v").count()).count() == 0


def test_optimize_is_a_new_snapshot_with_the_same_rows(spark, tmp_path):
    table = LakeTable(spark, str(tmp_path / "t"), partition_by=("d",), schema=frame(spark).schema)
    for i in range(3):
        table.append(frame(spark, ("a", "1", i), ("b", "2", i)))
    before = values(table.read())
    assert table.optimize(("k",)) == 6
    assert values(table.read()) == before
    health = layout.table_health(spark, {"t": table.location()}).first()
    assert health.file_count == 2 and health.size_bytes > 0


def test_stage_and_run_log(spark, tmp_path):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    stage = Stage(spark)
    assert stage.folder.startswith(shared_folder(spark))
    kept = stage.keep(frame(spark, ("a", "1", 1)), "x")
    assert values(kept) == [("a", "1", 1)]
    log = RunLog(spark, str(tmp_path / "log"))
    log.record("t", "append", 3, "2026-06-01 00:00:00")
    log.record("u", "overwrite", 4, "2026-06-01 00:00:00")
    assert values(log.read(), "table_name", "operation", "row_count") == [("t", "append", 3), ("u", "overwrite", 4)]
    assert log.read("u").count() == 1
