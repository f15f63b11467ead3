"""Line-grain pipeline: raw files to line history, order summary and regional metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.contracts import (LINE_BRONZE_KEY, LINE_KEY, LINE_LAKE_RULES, LINE_RAW, LINE_SIGNATURE,
                                 LINE_TYPES, ORDER_MONTH, ORDER_SUMMARY, PRICE, TRACKED, VERSION, widened)
from orderlake.functions import all_present, moment, month_of
from orderlake.operators import audit, gold, merge, quality, skew, standardize
from orderlake.plans import copies
from orderlake.plans.lake import FEW_DAYS, Lake, first_values, in_partitions, values_of
from orderlake.sources.raw import file_name, read_delivery

RAW = T.StructType([T.StructField(name, T.StringType()) for name in [*LINE_RAW, "_source_file"]]
                   + [T.StructField("_loaded_at", T.TimestampType())])
SILVER = T.StructType(LINE_TYPES.fields + VERSION.fields + [ORDER_MONTH])
SUMMARY = T.StructType(ORDER_SUMMARY.fields + [ORDER_MONTH])
#: Known while a delivery is checked only: whether the type of prices can hold the price delivered.
PRICE_FITS = T.StructField("price_fits", T.BooleanType())
RESERVED = [*SILVER.names, "closes_now", "key_hash", PRICE_FITS.name]
QUARANTINE = T.StructType(LINE_TYPES.fields + [
    T.StructField("_failed_rules", T.ArrayType(T.StringType())),
    T.StructField("_quarantined_at", T.TimestampType())])


class LineLake(Lake):
    """One run per delivered file set.

    Bronze and quarantine are kept by load date, silver and order summary by order month.
    Columns beyond the contract are carried as text by bronze, quarantine and silver.
    """

    def __init__(self, spark: SparkSession, root: str, rules=None):
        super().__init__(spark, root)
        self.rules = rules or LINE_LAKE_RULES
        self.load_days: dict[str, list] = {}
        self.bronze = self.table("bronze/lines", partition_by=("ingest_date",), schema=RAW)
        self.quarantine = self.table("quarantine/lines", partition_by=("ingest_date",), schema=QUARANTINE)
        self.silver = self.table("silver/lines", partition_by=("order_month",), schema=SILVER,
                                 cluster_by=("order_id", "region", "line_item_seq", "valid_from"))
        self.order_summary = self.table("gold/order_summary", partition_by=("order_month",),
                                        cluster_by=("order_id", "customer_id", "region"), schema=SUMMARY)
        # a handful of rows per day: never split by date, always one ordered set of files
        self.region_daily = self.table("gold/region_daily", cluster_by=("region", "order_date"))
        self.declare()

    def carriers(self):
        return [(self.bronze, RAW), (self.quarantine, QUARANTINE), (self.silver, SILVER)]

    def run(self, files: str | list[str], as_of: str) -> None:
        try:
            with self.timed("bronze", as_of):
                self.ingest(files, as_of)
            with self.timed("quality", as_of):
                good = self.check(as_of)
            with self.timed("merge", as_of):
                self.merge(good, as_of)
            with self.timed("gold", as_of):
                self.report(as_of)
        finally:
            self.end_run()

    # --- bronze -----------------------------------------------------------------

    def ingest(self, files: str | list[str], as_of: str) -> None:
        """Land raw rows as text; an order delivered again for a load date replaces its former rows.

        The first delivery is scanned once, any other once for its keys and once for its rows; a delivery of few
        load dates is written as it is read, where the first rows of the first one tell.  A load date that is no date becomes NULL, so
        the partitions a delivery can bring are days.  Only these are read and
        rewritten.  Rows without an order id or a load date can't be found by
        their key: when the same batch comes again, its former ones make way.
        """
        rows, found = read_delivery(self.spark, files, LINE_RAW, file_name(), "_source_file", RESERVED)
        stamped = standardize.stamp_lines(self.admit(rows, found, as_of), F.col("_source_file"), as_of)
        day = F.trim("ingest_date").try_cast("date")
        if not self.bronze.exists():
            # a partition column: only the names of the folders are text, not the day of each row
            dated = stamped.withColumn("ingest_date", day)
            self.append(self.bronze, dated, as_of, len(first_values(dated, "ingest_date")) <= FEW_DAYS)
            return
        raw = stamped.withColumn("ingest_date", day.cast("string"))
        brought = self.stage.keep(raw.select(*LINE_BRONZE_KEY).distinct(), "landed_keys")
        days = values_of(brought, "ingest_date")
        as_read = len(days) <= FEW_DAYS
        self.load_days[as_of] = days
        held = self.bronze.read().where(in_partitions("ingest_date", days))
        if held.isEmpty():
            self.append(self.bronze, raw, as_of, as_read)
            return
        keyless = ~all_present(LINE_BRONZE_KEY) & (F.col("_loaded_at") == moment(as_of))
        merged = self.replaced(held.where(~keyless), raw, LINE_BRONZE_KEY, "lines", brought)
        self.replace_partitions(self.bronze, merged, as_of, "upsert", as_read)

    def delivered(self, as_of: str) -> DataFrame:
        """Raw rows of the delivery stamped ``as_of``, from its load-date partitions where they are known."""
        rows = self.bronze.read().where(F.col("_loaded_at") == moment(as_of))
        days = self.load_days.get(as_of)
        return rows if days is None else rows.where(in_partitions("ingest_date", days))

    def audit(self, as_of: str) -> DataFrame:
        """Null, whitespace and non-positive counts of the delivery, in one scan."""
        return audit.batch_report(self.delivered(as_of), LINE_TYPES)

    # --- silver -----------------------------------------------------------------

    def typed(self, as_of: str) -> DataFrame:
        """The delivery trimmed and typed, with ``price_fits``."""
        text = standardize.trim_text(self.delivered(as_of))
        contract = widened(LINE_TYPES, self.extra).add(PRICE_FITS)
        return standardize.conform(
            text.withColumn(PRICE_FITS.name, standardize.fits(F.col("unit_price"), PRICE)), contract)

    def checked(self, as_of: str) -> DataFrame:
        """The delivery with the names of the rules each row fails, written aside and counted.

        Copies are found in two steps, first by an eight-byte hash of the
        signature, then exactly among the few rows that may share one.  All rows
        are checked and written once, as if they were no copies; the few that may be
        are then taken out again, compared in full and checked anew.
        """
        told = copies.tell_copies(self.stage, self.typed(as_of), LINE_SIGNATURE)
        layers, sure = quality.rule_layers(self.rules), ~F.col("_is_suspect")
        once, counts = self.counted(
            quality.check_flagged(told.withColumn("has_one_copy", all_present(LINE_SIGNATURE)), self.rules),
            "checked_lines", {layer: sure & condition for layer, condition in layers.items()})
        suspects = copies.flag_suspects(
            self.stage, once.where("_is_suspect").drop("_is_suspect", "_failed_rules"), LINE_SIGNATURE)
        anew, more = self.counted(quality.check_flagged(suspects, self.rules), "checked_suspects", layers)
        self.sizes += [(layer, counts[layer] + more[layer], as_of) for layer in layers]
        return once.where(sure).drop("_is_suspect").unionByName(anew).drop(PRICE_FITS.name)

    def check(self, as_of: str) -> DataFrame:
        """Quarantine the rows that fail a rule; returns the others.

        The checked rows are written aside once: quarantine and merge both need
        them, the merge several times.
        """
        checked = self.checked(as_of)
        same_load = F.col("_quarantined_at") == moment(as_of)
        self.write_batch(self.quarantine, quality.failed(checked, as_of), same_load, as_of)
        return quality.passed(checked)

    def merge(self, good: DataFrame, as_of: str) -> None:
        self.merge_history(self.silver, good.withColumn("order_month", month_of("order_date")), LINE_KEY, TRACKED, as_of)

    def refine(self, as_of: str) -> None:
        self.merge(self.check(as_of), as_of)

    # --- gold ---------------------------------------------------------------------

    def report(self, as_of: str) -> None:
        """Bring both gold tables up to date with the months whose lines changed.

        A month of the summary depends on that month of the lines alone.  The
        regional table reads the summary just written, not the lines.
        """
        months = self.to_report(self.silver, as_of, self.order_summary, self.region_daily)
        mine = F.lit(True) if months is None else in_partitions("order_month", months)
        lines = self.silver.read().where(mine)
        summary = gold.order_summary(lines).withColumn("order_month", month_of("order_date"))
        self.refresh(self.order_summary, summary, months, as_of, merge.current_versions(lines))
        daily = gold.region_daily(self.order_summary.read().where(mine))
        self.refresh_where(self.region_daily, daily, month_of("order_date"), months, as_of)
        self.reported(as_of)

    # --- checks -------------------------------------------------------------------

    def skew(self, columns: list[str] | None = None, top_n: int = 10) -> tuple[DataFrame, DataFrame]:
        """Statistics and heaviest keys per column of the line history; readable until ``end_run``."""
        counts = self.stage.keep(skew.value_counts(self.silver.read(), columns), "value_counts")
        return skew.skew_stats(counts), skew.heaviest_keys(counts, top_n)

    def order_check(self, order_id: str) -> tuple[DataFrame, DataFrame]:
        """Line statuses of one order, and its rolled-up status."""
        rolled = self.order_summary.read().where(F.col("order_id") == order_id).select("status")
        return gold.status_mix(self.silver.read(), order_id), rolled
