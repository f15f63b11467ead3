"""Raw deliveries derived from the star-schema test tables.

The tables hold no missing, padded, malformed or repeated values, so the
deliveries add such faults by fixed rules on the keys (see ``FIXTURES.md``).
A delivery is either the whole table or one of two overlapping batches, split by
order date: the second one brings known orders again, some of them progressed,
and new ones.  A third one brings the orders of the second again, some of them
cancelled in the meantime.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.contracts import (LINE_TYPES, NEW_ORDER, ORDER_LINEAGE, ORDER_TYPES, PROGRESSED,
                                 UNCHANGED)
from orderlake.operators.standardize import conform, stamp_lines, stamp_orders, subset_contract, trim_text

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
FIRST_DAY = "2026-06-01 00:00:00"
SECOND_DAY = "2026-06-02 00:00:00"
THIRD_DAY = "2026-06-03 00:00:00"

# fixed values: the first batch ends where new orders begin, the second starts earlier
NEW_SINCE = "2001-01-01"
SECOND_BATCH_SINCE = "2000-07-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _batch(orders: DataFrame, delivery: int | None) -> DataFrame:
    day = F.col("o_orderdate")
    if delivery == 1:
        return orders.where(day < F.lit(NEW_SINCE).cast("date"))
    if delivery in (2, 3):
        return orders.where(day >= F.lit(SECOND_BATCH_SINCE).cast("date"))
    return orders


def _is_known() -> Column:
    return F.col("o_orderdate") < F.lit(NEW_SINCE).cast("date")


def _variants(**extra: Column) -> Column:
    """The row itself, plus a named variant for each condition that holds."""
    return F.explode(F.array_compact(F.array(
        F.lit("base"), *[F.when(condition, F.lit(name)) for name, condition in extra.items()])))


def _price_text(name: str, key: Column) -> Column:
    """A price in cents, some with a third decimal, some above ten thousand million."""
    cents = F.col(name).cast("decimal(12,2)").cast("string")
    return F.when(key % 41 == 12, F.concat(F.lit("123456"), cents)).when(key % 43 == 13, F.concat(cents, F.lit("5"))) \
        .otherwise(cents)


# --- order grain ---------------------------------------------------------------

def raw_orders(spark: SparkSession, sf_dir: str, delivery: int | None = None,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Order rows as text.  ``keep`` passes scan columns such as ``_metadata`` fields through."""
    k = F.col("o_orderkey")
    placed = F.when(F.col("o_orderstatus") == "P", "placed").when(F.col("o_orderstatus") == "O", "shipped") \
        .otherwise("delivered")
    progressed = F.when(F.col("o_orderstatus") == "P", "shipped").otherwise("delivered")
    if delivery in (2, 3):
        placed = F.when(_is_known() & (k % 4 == 0), progressed).otherwise(placed)
    if delivery == 3:
        placed = F.when(_is_known() & (k % 12 == 0), "cancelled").otherwise(placed)
    status = F.when(k % 9 == 0, "cancelled").otherwise(placed)
    shout_on = 2 if delivery in (2, 3) else 1
    payments = F.array(*[F.lit(p) for p in
                         ("PayPal", "Credit_Card", "credit_card", "bank_transfer", "cash_on_delivery")])
    shift = F.when(F.col("variant") == "conflict", 1).otherwise(0)

    rows = _batch(table(spark, sf_dir, "orders"), delivery)
    rows = rows.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", *keep,
                       _variants(copy=k % 23 == 4, conflict=k % 17 == 6).alias("variant"))
    return rows.select(
        F.concat(F.lit("ORD"), k).alias("order_id"),
        F.concat(F.lit("CUST"), F.col("o_custkey")).alias("customer_id"),
        F.when(k % 11 == 5, "not_a_date").otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("order_date"),
        F.concat(F.lit("P"), 1000 + (k + shift) % 20).alias("product_id"),
        F.when(k % 39 == 3, None).when(k % 39 == 16, "0").when(k % 39 == 29, "-1")
        .otherwise((k % 5 + 1).cast("string")).alias("quantity"),
        F.when(k % 19 != 7, _price_text("o_totalprice", k)).alias("unit_price"),
        F.when(k % 7 == 0, F.concat(F.lit(" "), F.upper(status), F.lit(" ")))
        .when(k % 3 == shout_on, F.upper(status)).otherwise(status).alias("status"),
        F.when(k % 29 == 9, None).otherwise(F.get(payments, (k % 5).cast("int"))).alias("payment_method"),
        *[F.col(c) for c in (name.rsplit(".", 1)[-1] for name in keep)],
    )


def typed_orders(spark: SparkSession, sf_dir: str, delivery: int | None = None) -> DataFrame:
    as_of = SECOND_DAY if delivery == 2 else FIRST_DAY
    file = F.lit(f"order_batch{delivery}.csv" if delivery else "order_batch.csv")
    stamped = stamp_orders(raw_orders(spark, sf_dir, delivery), as_of, file, with_time=False)
    return conform(stamped, subset_contract(T.StructType(ORDER_TYPES.fields + ORDER_LINEAGE.fields),
                                            stamped.columns))


def manifest(first: DataFrame, second: DataFrame) -> DataFrame:
    """Expected outcome per order of the second clean batch, a few of them mislabelled on purpose."""
    before = first.select("order_id", F.col("status").alias("before"))
    k = F.substring("order_id", 4, 20).cast("long")
    expected = (F.when(F.col("before").isNull(), NEW_ORDER)
                .when(F.col("before") != F.col("status"),
                      F.when(k % 31 == 0, UNCHANGED).otherwise(PROGRESSED))
                .otherwise(F.when(k % 37 == 0, PROGRESSED).otherwise(UNCHANGED)))
    return (second.select("order_id", "status").join(before, "order_id", "left")
            .select("order_id", expected.alias("expected_category")))


# --- line grain ----------------------------------------------------------------

def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, line number and part, which make up the line key of the batches.

    Only rows that agree in all three (a few in ten thousand) are folded into one.
    The lines are dealt out by order before that, so that folding them and joining
    their orders takes one shuffle and no partial sums.
    """
    return (table(spark, sf_dir, "lineitem").repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber", "l_partkey")
            .agg(F.sum("l_quantity").alias("l_quantity"),
                 F.max("l_extendedprice").alias("l_extendedprice"),
                 F.min("l_returnflag").alias("l_returnflag"), F.min("l_linestatus").alias("l_linestatus")))


def placed_lines(spark: SparkSession, sf_dir: str, delivery: int | None = None, folded: bool = True) -> DataFrame:
    """Line items with the customer, date and region of their orders.

    Orders get their regions before they meet their lines, which are several
    times as many and are shuffled once only.
    """
    lines = _order_lines(spark, sf_dir) if folded else table(spark, sf_dir, "lineitem")
    places = (table(spark, sf_dir, "customer")
              .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
              .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
              .select("c_custkey", "r_name"))
    orders = (_batch(table(spark, sf_dir, "orders"), delivery)
              .join(places, F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "o_custkey", "o_orderdate", "r_name"))
    # both sides grow with the data, so the join is planned as a shuffled one from the start
    return (lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                    "l_returnflag", "l_linestatus", "o_custkey", "o_orderdate", "r_name"))


def raw_lines(spark: SparkSession, sf_dir: str, delivery: int | None = None,
              placed: DataFrame | None = None) -> DataFrame:
    """Line rows as text.

    The undivided delivery has every line item as it is; the two batches have
    line numbers made of line and part, so that their keys are unique.
    ``placed`` (see :func:`placed_lines`, all orders) may be passed in when it was
    already written to a table, for batches that are made of the same lines.
    """
    rows = placed_lines(spark, sf_dir, delivery, delivery is not None) if placed is None else _batch(placed, delivery)
    rows = rows.select("*", _variants(copy=F.col("l_partkey") % 59 == 11).alias("variant"))

    k, p, n = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    is_copy = F.when(F.col("variant") == "copy", 1).otherwise(0)
    seq = n + 100 * is_copy if delivery is None else p % 100_000_000 * 20 + n * 2 + is_copy
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    stages = ["PLACED", "PROCESSING", "SHIPPED", "DELIVERED"]
    stage = (F.when((line == "O") & (flag == "N"), 0).when((line == "O") & (flag == "R"), 1)
             .when(flag == "A", 2).when(flag == "N", 3))
    if delivery == 2:
        stage = stage + F.when(_is_known() & (n % 2 == 0) & (stage < 3), 1).otherwise(0)
    status = F.coalesce(F.get(F.array(*[F.lit(s) for s in stages]), stage), F.lit("CANCELLED"))
    ingest_day = (SECOND_DAY if delivery == 2 else FIRST_DAY)[:10]
    return rows.select(
        F.when(k % 97 != 1, k.cast("string")).alias("order_id"),
        F.when(k % 89 != 2, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(p % 83 != 3, p.cast("string")).alias("product_id"),
        F.when(p % 79 == 4, "0").when(p % 79 == 5, None)
        .otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("int"))).alias("quantity"),
        F.when(p % 73 == 6, "-1.00").otherwise(_price_text("l_extendedprice", p)).alias("unit_price"),
        F.when(k % 71 != 7, F.col("r_name")).alias("region"),
        F.when(p % 67 == 8, "RETURNED").when(p % 67 == 9, "shipped")
        .otherwise(F.concat(status, F.lit(" "))).alias("status"),
        F.when(k % 61 == 10, "not_a_date").otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("order_date"),
        seq.cast("string").alias("line_item_seq"),
        F.lit(ingest_day).alias("ingest_date"),
    )


def landed_lines(spark: SparkSession, sf_dir: str, delivery: int | None = None) -> DataFrame:
    file = F.lit(f"line_batch{delivery}.csv" if delivery else "line_batch.csv")
    return stamp_lines(raw_lines(spark, sf_dir, delivery), file)


def type_lines(landed: DataFrame) -> DataFrame:
    return conform(trim_text(landed), LINE_TYPES)


def typed_lines(spark: SparkSession, sf_dir: str, delivery: int | None = None) -> DataFrame:
    return type_lines(landed_lines(spark, sf_dir, delivery))


def redelivered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch as a correction: known orders carry the first load date again."""
    second = raw_lines(spark, sf_dir, 2)
    is_known = F.col("order_date").try_cast("date") < F.lit(NEW_SINCE).cast("date")
    return second.withColumn("ingest_date", F.when(is_known, FIRST_DAY[:10]).otherwise(F.col("ingest_date")))


def mended_lines(spark: SparkSession, sf_dir: str, placed: DataFrame | None = None) -> DataFrame:
    """The first batch once more, with its missing and zero quantities put right."""
    return raw_lines(spark, sf_dir, 1, placed).withColumn("quantity", F.coalesce(F.nullif("quantity", F.lit("0")), F.lit(" 1")))


def channelled_lines(spark: SparkSession, sf_dir: str, placed: DataFrame | None = None) -> DataFrame:
    """The second batch with a column that the contract doesn't name, in the middle of the others."""
    turn = F.col("line_item_seq").cast("bigint") % 3
    rows = raw_lines(spark, sf_dir, 2, placed).withColumn("channel", F.when(turn == 0, "web").when(turn == 1, " shop "))
    names = [c for c in rows.columns if c != "channel"]
    return rows.select(*names[:4], "channel", *names[4:])
