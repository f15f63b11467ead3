"""Data contracts: column types, keys, rule texts and status values."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# wide enough for any delivered price; only products and sums are rounded to cents
PRICE = T.DecimalType(20, 6)
MONEY = T.DecimalType(28, 2)

# --- order grain: one row per order ---------------------------------------

ORDER_RAW = ["order_id", "customer_id", "order_date", "product_id",
             "quantity", "unit_price", "status", "payment_method"]

ORDER_TYPES = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", PRICE),
    T.StructField("status", T.StringType()),
    T.StructField("payment_method", T.StringType()),
])

ORDER_LINEAGE = T.StructType([
    T.StructField("ingest_date", T.DateType()),
    T.StructField("source_filename", T.StringType()),
    T.StructField("ingest_at", T.TimestampType()),
])

ORDER_KEY = ["order_id"]
ORDER_BRONZE_KEY = ["order_id", "source_filename"]
ORDER_SIGNATURE = ORDER_RAW

# --- line grain: one row per line item of an order ------------------------

LINE_RAW = ["order_id", "customer_id", "product_id", "quantity", "unit_price",
            "region", "status", "order_date", "line_item_seq", "ingest_date"]

LINE_TYPES = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", PRICE),
    T.StructField("region", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("line_item_seq", T.IntegerType()),
    T.StructField("ingest_date", T.DateType()),
    T.StructField("_source_file", T.StringType()),
])

LINE_KEY = ["order_id", "line_item_seq"]
LINE_BRONZE_KEY = ["order_id", "ingest_date"]
LINE_SIGNATURE = ["order_id", "customer_id", "product_id", "quantity",
                  "unit_price", "region", "status", "order_date"]

TRACKED = ["status"]

VERSION = T.StructType([
    T.StructField("is_current", T.BooleanType()),
    T.StructField("valid_from", T.DateType()),
    T.StructField("valid_to", T.TimestampType()),
])

ORDER_SUMMARY = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("line_item_count", T.LongType()),
    T.StructField("total_quantity", T.LongType()),
    T.StructField("total_order_value", MONEY),
    T.StructField("status", T.StringType()),
])

#: Partition column of tables kept by order date: a month, so that folders stay few and large.
ORDER_MONTH = T.StructField("order_month", T.StringType())

# --- fixed values: names and texts that readers of the tables rely on ------

STATUS_RANK = {"CANCELLED": 0, "PLACED": 1, "PROCESSING": 2, "SHIPPED": 3, "DELIVERED": 4}
UNRANKED = 99
UNRANKED_LABEL = "UNKNOWN"
NO_PAYMENT = "unknown"

PROGRESSED = "progressed_status_should_create_new_scd2_version"
UNCHANGED = "unchanged_status_should_NOT_create_new_version"
NEW_ORDER = "new_order_should_be_fresh_insert"

REASON_CONFLICT = "conflicting_order_id"
REASON_QUANTITY = "invalid_quantity"
REASON_DATE = "invalid_date"
REASON_NO_KEY = "null_order_id"

SKEW_HIGH = 10
SKEW_LOW = 3


class Rule(NamedTuple):
    """A row-quality rule: the row passes when ``passes`` is true (NULL fails)."""

    name: str
    passes: str
    description: str


LINE_RULES = [
    Rule("order_id_not_null", "order_id IS NOT NULL", "the order id is present"),
    Rule("customer_id_not_null", "customer_id IS NOT NULL", "the customer id is present"),
    Rule("product_id_not_null", "product_id IS NOT NULL", "the product id is present"),
    Rule("quantity_greater_than_zero_&_not_null", "quantity > 0", "the quantity is a positive number"),
    Rule("unit_price_greater_than_zero_&_not_null", "unit_price > 0", "the unit price is a positive number"),
    Rule("region_not_null", "region IS NOT NULL", "the region is present"),
    Rule("status_valid", "status IN ('PLACED','PROCESSING','SHIPPED','DELIVERED','CANCELLED')",
         "the status is one of the five known ones, in upper case"),
    Rule("order_date_not_null", "order_date IS NOT NULL", "the order date is a real date"),
    Rule("row_signature_count_equals_1", "has_one_copy", "no other row has the same business values"),
]

#: What the line pipeline applies: a row without a line number has no key that a rerun could find it by, and a price
#: that its type cannot hold is not to pass for a missing one.
LINE_LAKE_RULES = [
    *LINE_RULES,
    Rule("line_item_seq_not_null", "line_item_seq IS NOT NULL", "the line number is present"),
    Rule("unit_price_fits", "price_fits", "the unit price is no number too large or too small for its type"),
]


def widened(contract: T.StructType, extra: list[str]) -> T.StructType:
    """A contract with further text columns."""
    return T.StructType(contract.fields + [T.StructField(name, T.StringType()) for name in extra])
