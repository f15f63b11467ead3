"""Plan shapes and hot groups."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlake.contracts import LINE_KEY, LINE_RULES, LINE_SIGNATURE, ORDER_KEY, ORDER_SIGNATURE, TRACKED
from orderlake.operators import duplicates, gold, layout, merge, quality, skew
from orderlake.operators.plan import plan_text
from orderlake.sources.tables import Stage
from samples import lines, orders


@pytest.fixture(scope="module")
def stored(spark):
    stage = Stage(spark)
    return {
        "orders": stage.keep(orders(spark, {}, dict(order_id="O2")), "orders"),
        "history": stage.keep(merge.open_versions(orders(spark, {})), "history"),
        "lines": stage.keep(lines(spark, {}, dict(order_id="2")), "lines"),
        "line_history": stage.keep(merge.open_versions(lines(spark, {})), "line_history"),
    }


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def operators(stored):
    flagged = duplicates.flag_orders(stored["orders"], "order_id", ORDER_SIGNATURE)
    checked = quality.check_rows(stored["lines"], LINE_RULES, LINE_SIGNATURE)
    merged = merge.merge_history(stored["history"], stored["orders"], ORDER_KEY, TRACKED, "2026-06-02 00:00:00")
    counts = skew.value_counts(stored["lines"])
    return {
        "flags": flagged, "clean": quality.clean_orders(flagged, ORDER_SIGNATURE),
        "rules": quality.failed(checked, "2026-06-02 00:00:00"),
        "upsert": merge.upsert(stored["orders"], stored["orders"], ORDER_KEY),
        "history": merged, "change log": gold.status_change_log(stored["history"]),
        "summary": gold.order_summary(stored["line_history"]),
        "region": gold.region_daily(gold.order_summary(stored["line_history"])),
        "skew": skew.skew_stats(counts), "top": skew.heaviest_keys(counts),
        "clustered": layout.cluster_rows(stored["orders"], ["order_id"]),
    }


def test_no_python_no_nested_loops_no_forced_broadcast(stored, no_broadcast):
    for name, frame in operators(stored).items():
        plan = plan_text(frame, name)
        for word in ("NestedLoop", "Cartesian", "Python", "ArrowEval"):
            assert word not in plan, (name, word)
        forced = plan_text(frame, mode="simple")
        assert "BroadcastExchange" not in forced, name


def test_windows_only_rank_slice_winners(stored):
    for name, frame in operators(stored).items():
        assert ("Window" in plan_text(frame)) == (name == "top"), name


def test_hot_value_ranking_is_limited_before_its_shuffle(stored):
    assert plan_text(operators(stored)["top"], mode="simple").count("WindowGroupLimit") == 4


def test_business_sums_use_hash_aggregation(stored):
    for name in ("summary", "region", "skew", "flags"):
        plan = plan_text(operators(stored)[name])
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan, name


def test_scan_reads_only_what_is_needed(stored):
    matches = merge.match_versions(stored["line_history"], stored["lines"], LINE_KEY, TRACKED)
    read = [line.split("struct<")[1].rstrip(">").split(",") for line in plan_text(matches).splitlines()
            if line.startswith("ReadSchema")]
    assert sorted(map(sorted, read)) == [
        ["is_current:boolean", "line_item_seq:int", "order_id:string", "status:string"],
        ["line_item_seq:int", "order_id:string", "status:string"]]
    one = gold.status_mix(stored["line_history"], "1")
    assert "EqualTo(order_id,1)" in plan_text(one)


def test_small_stored_side_needs_no_shuffle_of_the_rows(spark, stored):
    repeated = Stage(spark).keep(duplicates.repeated_signatures(stored["lines"], LINE_SIGNATURE), "repeated")
    plan = plan_text(duplicates.flag_copies(stored["lines"], LINE_SIGNATURE, repeated), mode="simple")
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


# --- a third of all rows in one group ------------------------------------------------------

N = 150_000


@pytest.fixture()
def small_skew_limits(spark):
    """Skew limits scaled down to the size of the test, as a cluster meets them at full size."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
                # one scan task per file, so that a hot group comes from many tasks
                "spark.sql.files.openCostInBytes": "128m"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_orders(spark):
    """A third under one id with different contents, a third exact copies of one row, a third plain."""
    base = orders(spark, {}).drop("order_id", "unit_price", "customer_id")
    part = F.col("id") % 3
    rows = (spark.range(0, N, 1, 16).crossJoin(F.broadcast(base))
            .withColumn("order_id", F.when(part == 0, "HOT").when(part == 1, "COPY").otherwise(F.concat(F.lit("O"), "id")))
            .withColumn("unit_price", F.when(part == 1, 5).otherwise(F.col("id") % 90 + 1).cast("decimal(12,2)"))
            .withColumn("customer_id", F.when(part == 1, "C").otherwise(F.concat(F.lit("C"), "id"))))
    return Stage(spark).keep(rows.select(*ORDER_SIGNATURE, "ingest_date", "source_filename"), "hot_orders")


def final_plan(frame):
    """Runs the frame without bringing rows here; the adaptive plan is final after that."""
    frame._jdf.queryExecution().toRdd().count()
    return plan_text(frame, mode="simple")


def largest_share(frame):
    """Part of all rows that the fullest task of the last stage holds."""
    sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    return max(sizes) / sum(sizes)


def test_hot_order_and_hot_copies(spark, small_skew_limits):
    rows = hot_orders(spark)
    flagged = duplicates.flag_orders(rows, "order_id", ORDER_SIGNATURE)
    assert largest_share(flagged) < 0.2
    assert flagged.where("is_conflicting").count() == N // 3
    assert quality.clean_orders(flagged, ORDER_SIGNATURE).count() == N // 3 + 1
    bad = quality.quarantined_orders(flagged, "2026-06-01 00:00:00")
    assert bad.groupBy("quarantine_reason").count().collect()[0]["count"] == N // 3


def test_rows_without_key_do_not_meet_in_one_task(spark, small_skew_limits):
    rows = hot_orders(spark).withColumn("order_id", F.when(F.col("order_id") != "HOT", F.col("order_id")))
    flagged = duplicates.flag_orders(rows, "order_id", ORDER_SIGNATURE)
    assert largest_share(flagged) < 0.2
    assert quality.quarantined_orders(flagged, "2026-06-01 00:00:00").count() == N // 3


def test_any_number_of_hot_groups_is_marked_without_a_limit(spark, small_skew_limits):
    base = orders(spark, {}).drop("order_id", "unit_price")
    rows = (spark.range(0, N, 1, 16).crossJoin(F.broadcast(base))
            .withColumn("order_id", F.concat(F.lit("G"), F.col("id") % 5000))
            .withColumn("unit_price", (F.col("id") + 1).cast("decimal(20,6)")))
    rows = Stage(spark).keep(rows.select(*ORDER_SIGNATURE, "ingest_date", "source_filename"), "many_hot_orders")
    flagged = duplicates.flag_orders(rows, "order_id", ORDER_SIGNATURE)
    assert "Limit" not in plan_text(flagged)
    assert largest_share(flagged) < 0.2
    assert flagged.where("is_conflicting").count() == N


def test_lookup_joins_split_a_hot_key(spark, small_skew_limits):
    rows = hot_orders(spark)
    replaced = merge.replace_key_groups(rows, rows.where("order_id = 'HOT'"), ORDER_KEY)
    assert "SortMergeJoin(skew=true)" in final_plan(replaced)
    assert replaced.count() == N
    history = merge.open_versions(rows)
    closed = merge.close_versions(history, rows, ORDER_KEY, "2026-06-02 00:00:00")
    assert "SortMergeJoin(skew=true)" in final_plan(closed)
    assert closed.where("is_current").count() == 0
    log = gold.status_change_log(Stage(spark).keep(closed, "closed"))
    assert "SortMergeJoin(skew=true)" in final_plan(log)
    assert log.count() == N


def test_hot_copies_of_a_line(spark, small_skew_limits):
    base = lines(spark, {}).drop("order_id", "line_item_seq", "unit_price")
    part = F.col("id") % 3
    rows = (spark.range(0, N, 1, 16).crossJoin(F.broadcast(base))
            .withColumn("order_id", F.when(part < 2, "7").otherwise(F.col("id").cast("string")))
            .withColumn("unit_price", F.when(part == 0, 3).otherwise(F.col("id") + 1).cast("decimal(12,2)"))
            .withColumn("line_item_seq", F.col("id").cast("int")))
    rows = Stage(spark).keep(rows.select(*LINE_SIGNATURE, "line_item_seq", "ingest_date", "_source_file"), "hot_lines")
    checked = quality.check_rows(rows, LINE_RULES, LINE_SIGNATURE)
    assert largest_share(checked) < 0.2
    good, bad = quality.passed(checked), quality.failed(checked, "2026-06-01 00:00:00")
    assert (good.count(), bad.count()) == (2 * N // 3, N // 3)

    good = Stage(spark).keep(good, "good")
    batch = good.withColumn("status", F.when(F.col("line_item_seq") % 2 == 0, "SHIPPED").otherwise(F.col("status")))
    changed = batch.where("status = 'SHIPPED'").count()
    history = merge.merge_history(merge.open_versions(good), batch, LINE_KEY, TRACKED, "2026-06-02 00:00:00")
    assert history.count() == 2 * N // 3 + changed
    assert history.where("NOT is_current").count() == changed
    summary = gold.order_summary(history).where("order_id = '7'").first()
    assert summary.line_item_count == N // 3
    assert summary.total_order_value == Decimal(2 * sum(i + 1 for i in range(N) if i % 3 == 1))
    top = skew.heaviest_keys(skew.value_counts(rows, ["order_id"]), 1).first()
    assert (top.value, top.row_count) == ("7", 2 * N // 3)
