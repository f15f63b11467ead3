"""Business tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.contracts import MONEY, STATUS_RANK, UNRANKED, UNRANKED_LABEL
from orderlake.functions import label_of, line_value, moment, rank_of
from orderlake.operators.merge import closed_versions, current_versions, one_per_key


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Revenue per order date and product; a missing factor counts as zero."""
    zero_filled = orders.fillna(0, subset=["quantity", "unit_price"])
    return (zero_filled.groupBy("order_date", "product_id")
            .agg(F.sum(line_value()).cast(MONEY).alias("daily_sum")))


def status_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(F.count("order_id").alias("order_count"))


def status_change_log(history: DataFrame, as_of: str | None = None, key: str = "order_id") -> DataFrame:
    """Every version of the keys that have a closed one."""
    log = history.join(one_per_key(closed_versions(history), [key]), key, "left_semi")
    return log if as_of is None else log.withColumn("gold_at", moment(as_of))


def refreshed_change_log(history: DataFrame, log: DataFrame, as_of: str, key: str = "order_id") -> DataFrame:
    """The change log of some partitions, given as their history and former log.

    A key is in the log once a version of it is closed.  Closing and new versions
    lie in the given partitions, and keys that were closed elsewhere before are in
    the former log, so no other partition is needed.
    """
    keys = closed_versions(history).select(key).union(log.select(key))
    return history.join(one_per_key(keys, [key]), key, "left_semi").withColumn("gold_at", moment(as_of))


def order_summary(history: DataFrame) -> DataFrame:
    """Current lines rolled up per order, customer, region and date.

    The status is the lowest-ranked one among the lines.  The rank is aggregated
    rather than the text, which keeps the buffers fixed-width and hashable.
    """
    ranked = current_versions(history).select(
        "order_id", "customer_id", "region", "order_date", "quantity",
        line_value().alias("line_value"),
        rank_of("status", STATUS_RANK, UNRANKED).alias("status_rank"))
    return (ranked.groupBy("order_id", "customer_id", "region", "order_date")
            .agg(F.count(F.lit(1)).alias("line_item_count"),
                 F.sum("quantity").alias("total_quantity"),
                 F.sum("line_value").cast(MONEY).alias("total_order_value"),
                 F.min("status_rank").alias("status_rank"))
            .withColumn("status", label_of("status_rank", STATUS_RANK, UNRANKED_LABEL))
            .drop("status_rank"))


def region_daily(summary: DataFrame) -> DataFrame:
    """Orders, quantity, revenue and mean order value per region and day.

    Takes the order summary, not the lines: its sums are exact decimals, so they
    add up to the same totals, and the lines need not be read a second time.
    """
    return (summary.groupBy("region", "order_date")
            .agg(F.count_distinct("order_id").alias("order_count"),
                 F.sum("total_quantity").alias("_total_quantity"),
                 F.sum("total_order_value").cast(MONEY).alias("total_revenue"))
            .withColumn("avg_order_value",
                        F.round(F.col("total_revenue") / F.col("order_count"), 2).cast(MONEY)))


def status_mix(history: DataFrame, order_id: str) -> DataFrame:
    """Current line statuses of one order, to hold against its rolled-up status."""
    return (current_versions(history).where(F.col("order_id") == order_id)
            .groupBy("status").agg(F.count(F.lit(1)).alias("line_count")))
