"""Named queries over the test tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.contracts import (LINE_BRONZE_KEY, LINE_KEY, LINE_RULES, LINE_SIGNATURE, ORDER_KEY,
                                 ORDER_RAW, ORDER_SIGNATURE, TRACKED)
from orderlake.operators import (audit, duplicates, gold, layout, merge, quality, reconcile, skew,
                                 standardize)
from orderlake.plans import copies
from orderlake.plans import deliveries as given
from orderlake.plans.lines import LineLake
from orderlake.plans.orders import OrderLake
from orderlake.sources.runlog import RunLog
from orderlake.sources.tables import LakeTable, Stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY1, DAY2, DAY3 = given.FIRST_DAY, given.SECOND_DAY, given.THIRD_DAY
#: Rows of a delivered file at most.
ROWS_PER_FILE = 1_000_000


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


# --- order grain: one batch ------------------------------------------------------

def flagged(spark: SparkSession, sf_dir: str, delivery: int | None = None) -> DataFrame:
    return duplicates.flag_orders(given.typed_orders(spark, sf_dir, delivery), "order_id", ORDER_SIGNATURE)


def clean(spark: SparkSession, sf_dir: str, delivery: int | None = None) -> DataFrame:
    return quality.clean_orders(flagged(spark, sf_dir, delivery), ORDER_SIGNATURE)


@query
def bronze_ingest(spark, sf_dir):
    raw = given.raw_orders(spark, sf_dir, keep=("_metadata.file_name",))
    return standardize.stamp_orders(raw, DAY1, F.col("file_name")).drop("file_name")


@query
def typed_orders(spark, sf_dir):
    return given.typed_orders(spark, sf_dir)


@query
def null_audit_orders(spark, sf_dir):
    return audit.null_counts(given.typed_orders(spark, sf_dir), ORDER_RAW)


@query
def null_audit_clean_orders(spark, sf_dir):
    return audit.null_counts(clean(spark, sf_dir), ORDER_RAW)


@query
def nonpositive_rows(spark, sf_dir):
    return audit.nonpositive_rows(given.typed_orders(spark, sf_dir), "quantity")


@query
def duplicate_keys(spark, sf_dir):
    return audit.repeated_keys(given.typed_orders(spark, sf_dir), ORDER_KEY)


@query
def conflicting_orders(spark, sf_dir):
    return duplicates.conflicting_keys(given.typed_orders(spark, sf_dir), "order_id", ORDER_SIGNATURE)


@query
def dup_conflict_flags(spark, sf_dir):
    return flagged(spark, sf_dir)


@query
def quarantine_orders(spark, sf_dir):
    return quality.quarantined_orders(flagged(spark, sf_dir), DAY1)


@query
def quarantine_reason_counts(spark, sf_dir):
    bad = quality.quarantined_orders(flagged(spark, sf_dir), DAY1)
    return bad.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("row_count"))


@query
def clean_orders(spark, sf_dir):
    return clean(spark, sf_dir)


@query
def dropped_null_price(spark, sf_dir):
    return quality.unpriced_orders(flagged(spark, sf_dir))


@query
def gold_daily_revenue(spark, sf_dir):
    return gold.daily_revenue(clean(spark, sf_dir))


@query
def gold_status_counts(spark, sf_dir):
    return gold.status_counts(clean(spark, sf_dir))


@query
def layer_counts(spark, sf_dir):
    return quality.layer_sizes(flagged(spark, sf_dir), ORDER_SIGNATURE)


# --- order grain: two batches ----------------------------------------------------
#
# As in the pipeline, the clean batches are written aside once: history, manifest
# and checks each need them several times, and their sizes are then known.

def order_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    stage = Stage(spark)
    return (stage.keep(clean(spark, sf_dir, 1), "first"), stage.keep(clean(spark, sf_dir, 2), "second"))


def merged_orders(first: DataFrame, second: DataFrame) -> DataFrame:
    return merge.merge_history(merge.open_versions(first), second, ORDER_KEY, TRACKED, DAY2)


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_orders(*order_batches(spark, sf_dir))


def stored_order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Stage(spark).keep(order_history(spark, sf_dir), "history")


def history_and_manifest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    first, second = order_batches(spark, sf_dir)
    return merged_orders(first, second), given.manifest(first, second)


@query
def upsert_orders(spark, sf_dir):
    return merge.upsert(*order_batches(spark, sf_dir), ORDER_KEY)


@query
def scd2_orders(spark, sf_dir):
    return order_history(spark, sf_dir)


@query
def scd2_expired(spark, sf_dir):
    first, second = order_batches(spark, sf_dir)
    matches = merge.match_versions(merge.open_versions(first), second, ORDER_KEY, TRACKED)
    return merge.changed_keys(matches, ORDER_KEY)


@query
def scd2_inserted(spark, sf_dir):
    first, second = order_batches(spark, sf_dir)
    matches = merge.match_versions(merge.open_versions(first), second, ORDER_KEY, TRACKED)
    return merge.open_versions(merge.fresh_rows(second, matches, ORDER_KEY))


@query
def scd2_version_counts(spark, sf_dir):
    return audit.version_counts(order_history(spark, sf_dir))


@query
def scd2_one_order(spark, sf_dir):
    history = stored_order_history(spark, sf_dir)
    first_changed = merge.closed_versions(history).agg(F.min("order_id").alias("order_id"))
    return audit.versions_of(history, "order_id", first_changed.scalar())


@query
def gold_status_change_log(spark, sf_dir):
    return gold.status_change_log(stored_order_history(spark, sf_dir), DAY2)


@query
def scd2_version_mismatch(spark, sf_dir):
    log = Stage(spark).keep(gold.status_change_log(stored_order_history(spark, sf_dir)), "change_log")
    return reconcile.version_mismatches(log)


@query
def manifest_categories(spark, sf_dir):
    return (given.manifest(*order_batches(spark, sf_dir)).groupBy("expected_category")
            .agg(F.count(F.lit(1)).alias("order_count")))


@query
def recon_missing(spark, sf_dir):
    return reconcile.missing_history(*history_and_manifest(spark, sf_dir))


@query
def recon_unexpected(spark, sf_dir):
    return reconcile.unexpected_history(*history_and_manifest(spark, sf_dir))


@query
def recon_wrong_history(spark, sf_dir):
    return reconcile.wrong_history(*history_and_manifest(spark, sf_dir))


@query
def recon_summary(spark, sf_dir):
    return reconcile.reconciliation(*history_and_manifest(spark, sf_dir))


# --- line grain: quality -----------------------------------------------------------

def landed_lines(spark: SparkSession, sf_dir: str, delivery: int | None = None) -> DataFrame:
    """Typed rows over a delivery that was landed as text, as the pipeline reads them."""
    landed = Stage(spark).keep(given.landed_lines(spark, sf_dir, delivery), "landed")
    return given.type_lines(landed)


def checked(spark: SparkSession, sf_dir: str, delivery: int | None = None) -> DataFrame:
    flagged = copies.flag_copies(Stage(spark), landed_lines(spark, sf_dir, delivery), LINE_SIGNATURE)
    return quality.check_flagged(flagged, LINE_RULES)


def rules_as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_failed_rules", F.concat_ws(",", "_failed_rules"))


@query
def whitespace_audit(spark, sf_dir):
    return audit.whitespace_counts(given.raw_lines(spark, sf_dir))


@query
def trim_cast_lines(spark, sf_dir):
    return given.typed_lines(spark, sf_dir)


@query
def null_audit_lines(spark, sf_dir):
    return audit.null_counts(given.typed_lines(spark, sf_dir))


@query
def nonpositive_audit(spark, sf_dir):
    return audit.nonpositive_counts(given.typed_lines(spark, sf_dir))


@query
def dq_failed_rules(spark, sf_dir):
    return (rules_as_text(checked(spark, sf_dir)).groupBy("_failed_rules")
            .agg(F.count(F.lit(1)).alias("row_count")))


@query
def dq_rule_counts(spark, sf_dir):
    return quality.rule_failures(checked(spark, sf_dir))


@query
def dq_good(spark, sf_dir):
    return quality.passed(checked(spark, sf_dir))


@query
def dq_bad(spark, sf_dir):
    return rules_as_text(quality.failed(checked(spark, sf_dir), DAY1))


# --- line grain: history and business tables ---------------------------------------

def line_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark)
    first = stage.keep(quality.passed(checked(spark, sf_dir, 1)), "first")
    second = stage.keep(quality.passed(checked(spark, sf_dir, 2)), "second")
    return merge.merge_history(merge.open_versions(first), second, LINE_KEY, TRACKED, DAY2)


@query
def bronze_upsert_lines(spark, sf_dir):
    again = Stage(spark).keep(given.redelivered_lines(spark, sf_dir), "again")
    return merge.replace_key_groups(given.raw_lines(spark, sf_dir, 1), again, LINE_BRONZE_KEY)


@query
def scd2_lines(spark, sf_dir):
    return line_history(spark, sf_dir)


@query
def gold_order_summary(spark, sf_dir):
    return gold.order_summary(line_history(spark, sf_dir))


@query
def gold_region_daily(spark, sf_dir):
    summary = gold.order_summary(line_history(spark, sf_dir))
    return gold.region_daily(summary)


@query
def order_status_mix(spark, sf_dir):
    history = Stage(spark).keep(line_history(spark, sf_dir), "history")
    first_changed = merge.closed_versions(history).agg(F.min("order_id").alias("order_id"))
    return gold.status_mix(history, first_changed.scalar())


# --- whole pipelines, from delivered files to tables ---------------------------------

def delivered(spark: SparkSession, rows: DataFrame, path: str) -> str:
    """A delivery as compressed CSV files with a header, spaces kept.

    Such a file is read by one task, so none holds more rows than a task sorts in memory.
    """
    (rows.write.option("header", True).option("maxRecordsPerFile", ROWS_PER_FILE)
     .option("zlib.compress.level", "BEST_SPEED")
     .csv(path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip"))
    return path


def placed(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The lines that several deliveries are made of, put together once."""
    return Stage(spark, folder).keep(given.placed_lines(spark, sf_dir), "placed_lines")


def line_lake(spark: SparkSession, sf_dir: str, again: bool = False) -> LineLake:
    """Both line batches through the pipeline; ``again`` brings the second one twice."""
    folder = Stage(spark).folder
    lake = LineLake(spark, f"{folder}/lake")
    lines = placed(spark, sf_dir, folder)
    lake.run(delivered(spark, given.raw_lines(spark, sf_dir, 1, lines), f"{folder}/day1"), DAY1)
    second = delivered(spark, given.raw_lines(spark, sf_dir, 2, lines), f"{folder}/day2")
    for _ in range(2 if again else 1):
        lake.run(second, DAY2)
    return lake


def order_lake(spark: SparkSession, sf_dir: str, keep_history: bool = True, batches: int = 2) -> OrderLake:
    folder = Stage(spark).folder
    lake = OrderLake(spark, f"{folder}/lake", keep_history)
    for day, as_of in list(enumerate((DAY1, DAY2, DAY3), 1))[:batches]:
        lake.run(delivered(spark, given.raw_orders(spark, sf_dir, day), f"{folder}/day{day}"), as_of)
    return lake


def widening_lake(spark: SparkSession, sf_dir: str) -> LineLake:
    """Both line batches, the second one with a column that the first has not."""
    folder = Stage(spark).folder
    lake = LineLake(spark, f"{folder}/lake")
    lines = placed(spark, sf_dir, folder)
    lake.run(delivered(spark, given.raw_lines(spark, sf_dir, 1, lines), f"{folder}/day1"), DAY1)
    lake.run(delivered(spark, given.channelled_lines(spark, sf_dir, lines), f"{folder}/day2"), DAY2)
    return lake


def corrected_lake(spark: SparkSession, sf_dir: str) -> LineLake:
    """The first line batch, and the same batch once more with its quantities put right."""
    folder = Stage(spark).folder
    lake = LineLake(spark, f"{folder}/lake")
    lines = placed(spark, sf_dir, folder)
    lake.run(delivered(spark, given.raw_lines(spark, sf_dir, 1, lines), f"{folder}/day1"), DAY1)
    lake.run(delivered(spark, given.mended_lines(spark, sf_dir, lines), f"{folder}/again"), DAY1)
    return lake


@query
def lake_line_history(spark, sf_dir):
    return line_lake(spark, sf_dir).silver.read().drop("_source_file", "order_month")


@query
def lake_line_history_again(spark, sf_dir):
    return line_lake(spark, sf_dir, again=True).silver.read().drop("_source_file", "order_month")


@query
def lake_line_quarantine(spark, sf_dir):
    return rules_as_text(line_lake(spark, sf_dir).quarantine.read()).drop("_source_file")


@query
def lake_order_summary(spark, sf_dir):
    return line_lake(spark, sf_dir).order_summary.read().drop("order_month")


@query
def lake_region_daily(spark, sf_dir):
    return line_lake(spark, sf_dir).region_daily.read()


@query
def lake_order_history(spark, sf_dir):
    return order_lake(spark, sf_dir).silver.read().drop("source_filename", "ingest_at")


@query
def lake_status_change_log(spark, sf_dir):
    return order_lake(spark, sf_dir).change_log.read().drop("source_filename", "ingest_at")


@query
def lake_new_column_bronze(spark, sf_dir):
    return widening_lake(spark, sf_dir).bronze.read().drop("_source_file", "_loaded_at")


@query
def lake_new_column_quarantine(spark, sf_dir):
    return rules_as_text(widening_lake(spark, sf_dir).quarantine.read()).drop("_source_file")


@query
def lake_corrected_quarantine(spark, sf_dir):
    return rules_as_text(corrected_lake(spark, sf_dir).quarantine.read()).drop("_source_file")


@query
def lake_corrected_summary(spark, sf_dir):
    return corrected_lake(spark, sf_dir).order_summary.read().drop("order_month")


@query
def lake_single_orders(spark, sf_dir):
    lake = order_lake(spark, sf_dir, keep_history=False)
    return lake.silver.read().drop("source_filename", "ingest_at", "order_month")


@query
def lake_daily_revenue(spark, sf_dir):
    return order_lake(spark, sf_dir, keep_history=False).daily_revenue.read()


@query
def lake_redelivered_orders(spark, sf_dir):
    """Bronze after the files of one day have come again on the next."""
    folder = Stage(spark).folder
    lake = OrderLake(spark, f"{folder}/lake")
    files = delivered(spark, given.raw_orders(spark, sf_dir, 1), f"{folder}/day1")
    for as_of in (DAY1, DAY2):
        lake.run(files, as_of)
    return lake.bronze.read().drop("source_filename", "ingest_at")


@query
def lake_recon_manifest(spark, sf_dir):
    """The history of the lake held against a manifest file."""
    lake = order_lake(spark, sf_dir)
    expected = given.manifest(*order_batches(spark, sf_dir))
    return lake.reconcile(delivered(spark, expected, f"{Stage(spark).folder}/manifest"))["summary"]


@query
def lake_three_batches(spark, sf_dir):
    return order_lake(spark, sf_dir, batches=3).silver.read().drop("source_filename", "ingest_at")


@query
def lake_version_mismatch(spark, sf_dir):
    """Orders with more or fewer than two versions after three batches."""
    return reconcile.version_mismatches(order_lake(spark, sf_dir, batches=3).change_log.read())


@query
def lake_order_layers(spark, sf_dir):
    """Rows that each layer took of both order batches, as the writes counted them."""
    return order_lake(spark, sf_dir).layers.read()


@query
def lake_line_layers(spark, sf_dir):
    """The same for both line batches, with the rows that failed each rule."""
    return line_lake(spark, sf_dir).layers.read()


# --- skew and storage ----------------------------------------------------------------

@query
def skew_stats(spark, sf_dir):
    return skew.skew_stats(skew.value_counts(given.typed_lines(spark, sf_dir)))


@query
def skew_topk(spark, sf_dir):
    return skew.heaviest_keys(skew.value_counts(given.typed_lines(spark, sf_dir)), top_n=10)


@query
def clustered_rewrite(spark, sf_dir):
    folder = Stage(spark).folder
    stored = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return_to = LakeTable(spark, f"{folder}/lineitem_by_order")
    return_to.publish(layout.cluster_rows(stored, ["l_orderkey", "l_suppkey"]))
    return return_to.read()


@query
def table_health(spark, sf_dir):
    """Rows of every given table, counted from the rows themselves."""
    return audit.layer_counts({name: given.table(spark, sf_dir, name) for name in given.TABLES})


@query
def table_files(spark, sf_dir):
    """Rows of every given table, and whether it has files and bytes."""
    health = layout.stored_health({name: given.table(spark, sf_dir, name) for name in given.TABLES})
    return health.select("table_name", "row_count", (F.col("file_count") > 0).alias("has_files"),
                         (F.col("size_bytes") > 0).alias("has_bytes"))


@query
def run_log(spark, sf_dir):
    folder = Stage(spark).folder
    log = RunLog(spark, f"{folder}/run_log")
    silver = LakeTable(spark, f"{folder}/silver_orders", partition_by=("ingest_date",))
    log.record(silver.name, "append", silver.append(clean(spark, sf_dir, 1)), DAY1)
    merged = merge.upsert(silver.read(), clean(spark, sf_dir, 2), ORDER_KEY)
    log.record(silver.name, "upsert", silver.publish(merged), DAY2)
    counts = LakeTable(spark, f"{folder}/gold_status_counts")
    log.record(counts.name, "overwrite", counts.publish(gold.status_counts(silver.read())), DAY2)
    return log.read()
