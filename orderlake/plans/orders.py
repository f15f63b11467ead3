"""Order-grain pipeline: raw files to clean orders or order history, and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.contracts import (ORDER_BRONZE_KEY, ORDER_KEY, ORDER_LINEAGE, ORDER_MONTH, ORDER_RAW,
                                 ORDER_SIGNATURE, ORDER_TYPES, TRACKED, VERSION, widened)
from orderlake.functions import moment, month_of
from orderlake.operators import audit, duplicates, gold, quality, reconcile, standardize
from orderlake.plans.lake import Lake, in_partitions
from orderlake.sources.raw import file_uri, files_of, read_delivery, read_text_columns

TYPED = T.StructType(ORDER_TYPES.fields + ORDER_LINEAGE.fields)
RAW = T.StructType([T.StructField(name, T.StringType()) for name in ORDER_RAW] + ORDER_LINEAGE.fields)
QUARANTINE = T.StructType(TYPED.fields + [
    T.StructField("quarantine_reason", T.StringType()),
    T.StructField("quarantine_at", T.TimestampType())])
SINGLE = T.StructType(TYPED.fields + [ORDER_MONTH])
HISTORY = T.StructType(TYPED.fields + VERSION.fields)
CHANGES = T.StructType(HISTORY.fields + [T.StructField("gold_at", T.TimestampType())])
RESERVED = [*QUARANTINE.names, *SINGLE.names, *CHANGES.names, *quality.FLAGS, "lineage", "closes_now", "key_hash",
            "dup_count", "distinct_row_count"]


class OrderLake(Lake):
    """One run per delivered file set.

    ``keep_history=False`` holds one clean row per order; ``True`` holds every
    status an order went through.  Columns beyond the contract are carried as text by
    bronze, quarantine, silver and the change log.
    """

    def __init__(self, spark: SparkSession, root: str, keep_history: bool = False):
        super().__init__(spark, root)
        self.keep_history = keep_history
        silver_by = "ingest_date" if keep_history else "order_month"
        self.bronze = self.table("bronze/orders", partition_by=("ingest_date",), schema=RAW)
        self.quarantine = self.table("quarantine/orders", partition_by=("ingest_date",), schema=QUARANTINE)
        self.silver = self.table("silver/orders", partition_by=(silver_by,), cluster_by=("order_id",),
                                 schema=HISTORY if keep_history else SINGLE)
        self.daily_revenue = self.table("gold/daily_revenue")
        self.status_counts = self.table("gold/status_counts")
        self.change_log = self.table("gold/status_change_log", partition_by=("ingest_date",), schema=CHANGES)
        self.declare()

    def carriers(self):
        return [(self.bronze, RAW), (self.quarantine, QUARANTINE), (self.change_log, CHANGES),
                (self.silver, HISTORY if self.keep_history else SINGLE)]

    def run(self, files: str | list[str], as_of: str) -> None:
        try:
            with self.timed("bronze", as_of):
                self.ingest(files, as_of)
            with self.timed("silver", as_of):
                self.refine(as_of)
            with self.timed("gold", as_of):
                self.report(as_of)
        finally:
            self.end_run()

    # --- bronze -----------------------------------------------------------------

    def ingest(self, files: str | list[str], as_of: str) -> None:
        """Land raw rows as they are; files delivered again replace their former orders.

        Whether a file was landed before is told by the file ledger, so that new files
        are appended without a look at older bronze rows.
        """
        rows, found = read_delivery(self.spark, files, ORDER_RAW, file_uri(), "source_filename", RESERVED)
        raw = standardize.stamp_orders(self.admit(rows, found, as_of), as_of, F.col("source_filename"))
        named = files_of(self.spark, files)
        known = self.files.knows_any(named)
        if not known and named:
            self.files.note(named, as_of)
        if known:
            self.upsert(self.bronze, self.stage.keep(raw, "landed_orders"), ORDER_BRONZE_KEY, as_of)
        else:
            self.append(self.bronze, raw, as_of, as_read=True)  # one load date

    def delivered(self, as_of: str) -> DataFrame:
        """Typed rows of the delivery stamped ``as_of``; only its load-date partition is read."""
        mine = (F.col("ingest_date") == F.to_date(moment(as_of))) & (F.col("ingest_at") == moment(as_of))
        return standardize.conform(self.bronze.read().where(mine), widened(TYPED, self.extra))

    # --- silver -----------------------------------------------------------------

    def flagged(self, as_of: str) -> DataFrame:
        """The delivery with its three flags.

        Repeated ids are found from the id column alone; whole rows are compared
        only for those.  Both small results are written aside, so their size is
        known when the flags are joined.
        """
        typed = self.delivered(as_of)
        repeated = self.stage.keep(audit.repeated_keys(typed, ORDER_KEY).select(*ORDER_KEY), "repeated_orders")
        suspects = typed.join(repeated, ORDER_KEY, "left_semi")
        stats = self.stage.keep(
            duplicates.repeated_key_stats(suspects, "order_id", ORDER_SIGNATURE), "repeated_order_stats")
        flagged = duplicates.flag_orders(typed, "order_id", ORDER_SIGNATURE, stats)
        return self.keep_counted(flagged, "flagged_orders", quality.order_layers(), as_of)

    def refine(self, as_of: str) -> None:
        flagged = self.flagged(as_of)
        same_load = F.col("ingest_at") == moment(as_of)
        self.write_batch(self.quarantine, quality.quarantined_orders(flagged, as_of), same_load, as_of)
        clean = self.keep_counted(quality.clean_orders(flagged, ORDER_SIGNATURE), "clean_orders",
                                  {"clean": F.lit(True)}, as_of)
        if self.keep_history:
            self.merge_history(self.silver, clean, ORDER_KEY, TRACKED, as_of)
        else:
            monthly = clean.withColumn("order_month", month_of("order_date"))
            self.upsert(self.silver, self.unique(monthly, ORDER_KEY), ORDER_KEY, as_of)

    # --- gold ---------------------------------------------------------------------

    def report(self, as_of: str) -> None:
        """Bring the reports up to date with the partitions of silver that changed."""
        if self.keep_history:
            days = self.to_report(self.silver, as_of, self.change_log)
            if days is None:
                log = gold.status_change_log(self.silver.read(), as_of)
            else:
                mine = in_partitions("ingest_date", days)
                log = gold.refreshed_change_log(self.silver.read().where(mine), self.change_log.read().where(mine), as_of)
            self.refresh(self.change_log, log, days, as_of)
        else:
            months = self.to_report(self.silver, as_of, self.daily_revenue)
            mine = F.lit(True) if months is None else in_partitions("order_month", months)
            revenue = gold.daily_revenue(self.silver.read().where(mine))
            self.refresh_where(self.daily_revenue, revenue, month_of("order_date"), months, as_of)
            self.publish(self.status_counts, gold.status_counts(self.silver.read()), as_of)
        self.reported(as_of)

    # --- checks -------------------------------------------------------------------

    def audit(self, as_of: str) -> DataFrame:
        """Null, whitespace and non-positive counts of the delivery, in one scan."""
        mine = (F.col("ingest_date") == F.to_date(moment(as_of))) & (F.col("ingest_at") == moment(as_of))
        return audit.batch_report(self.bronze.read().where(mine), ORDER_TYPES)

    def reconcile(self, manifest_files: str) -> dict[str, DataFrame]:
        """History held against a manifest file ``order_id,expected_category``."""
        manifest = read_text_columns(self.spark, manifest_files, ["order_id", "expected_category"])
        history = self.silver.read()
        return {
            "missing": reconcile.missing_history(history, manifest),
            "unexpected": reconcile.unexpected_history(history, manifest),
            "wrongly_versioned": reconcile.wrong_history(history, manifest),
            "summary": reconcile.reconciliation(history, manifest),
            "version_mismatches": reconcile.version_mismatches(self.change_log.read()),
        }
