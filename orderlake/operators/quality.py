"""Row quality: named rules, quarantine reasons and the good/bad split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.contracts import (NO_PAYMENT, REASON_CONFLICT, REASON_DATE, REASON_NO_KEY,
                                 REASON_QUANTITY, Rule)
from orderlake.functions import is_true, moment, tidy_lower
from orderlake.operators.duplicates import flag_copies

FLAGS = ["is_conflicting", "is_invalid_quantity", "is_invalid_date"]


# --- rules as data -----------------------------------------------------------

def apply_rules(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``_failed_rules``: the names of the rules a row fails, in rule order.

    Names are not empty.  Empty ones are taken out again rather than NULLs, as Spark
    compiles that function and the rules with it.
    """
    return rows.withColumn("_failed_rules", F.array_remove(F.array(*[
        F.when(~is_true(F.expr(rule.passes)), F.lit(rule.name)).otherwise(F.lit("")) for rule in rules
    ]), ""))


def check_rows(rows: DataFrame, rules: list[Rule], signature: list[str],
               repeated: DataFrame | None = None) -> DataFrame:
    """Copy check plus rules; the result has the input columns and ``_failed_rules``."""
    return check_flagged(flag_copies(rows, signature, repeated), rules)


def check_flagged(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rules only, for rows that have ``has_one_copy`` already; it is left out of the result."""
    return apply_rules(flagged, rules).drop("has_one_copy")


def passed(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("_failed_rules") == 0).drop("_failed_rules")


def failed(checked: DataFrame, as_of: str) -> DataFrame:
    return checked.where(F.size("_failed_rules") > 0).withColumn("_quarantined_at", moment(as_of))


def rule_failures(checked: DataFrame) -> DataFrame:
    """Failing rows per rule."""
    return (checked.select(F.explode("_failed_rules").alias("rule"))
            .groupBy("rule").agg(F.count(F.lit(1)).alias("row_count")))


def rule_layers(rules: list[Rule]) -> dict[str, Column]:
    """Which checked rows each layer takes, and which fail each rule."""
    failures = F.size("_failed_rules")
    return {"landed": F.lit(True), "quarantined": failures > 0, "passed": failures == 0,
            **{rule.name: (failures > 0) & F.array_contains("_failed_rules", rule.name) for rule in rules}}


# --- order-grain flags -------------------------------------------------------

def quarantined_orders(flagged: DataFrame, as_of: str, key: str = "order_id") -> DataFrame:
    """Rows with a raised flag or no key, with their reasons joined by ``+``."""
    reasons = F.concat_ws(
        "+",
        F.when(F.col(key).isNull(), F.lit(REASON_NO_KEY)),
        F.when(F.col("is_conflicting"), F.lit(REASON_CONFLICT)),
        F.when(F.col("is_invalid_quantity"), F.lit(REASON_QUANTITY)),
        F.when(F.col("is_invalid_date"), F.lit(REASON_DATE)),
    )
    return (flagged.withColumn("quarantine_reason", reasons)
            .where(F.col("quarantine_reason") != "")
            .withColumn("quarantine_at", moment(as_of))
            .drop(*FLAGS))


def accepted_orders(flagged: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows with a key and no raised flag, copies still in."""
    raised = F.lit(False)
    for flag in FLAGS:
        raised = raised | F.col(flag)
    return flagged.where(F.col(key).isNotNull() & ~raised).drop(*FLAGS)


def unpriced_orders(flagged: DataFrame, required: tuple[str, ...] = ("quantity", "unit_price")) -> DataFrame:
    """Accepted rows that cleaning leaves out because a required number is missing."""
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    return accepted_orders(flagged).where(missing)


def order_layers(key: str = "order_id", required: tuple[str, ...] = ("quantity", "unit_price")) -> dict[str, Column]:
    """Which flagged rows each layer takes, copies still in."""
    refused, missing = F.col(key).isNull(), F.lit(False)
    for flag in FLAGS:
        refused = refused | F.col(flag)
    for name in required:
        missing = missing | F.col(name).isNull()
    return {"raw": F.lit(True), "quarantine": refused, "unpriced": ~refused & missing, "priced": ~refused & ~missing}


def layer_sizes(flagged: DataFrame, signature: list[str]) -> DataFrame:
    """``layer, row_count`` of all layers that come out of the flagged rows, in one scan of them.

    Rows are counted per signature first, as the silver layer has one row of each.
    """
    layers = order_layers()
    groups = flagged.groupBy(*signature).agg(*[F.count_if(taken).alias(layer) for layer, taken in layers.items()])
    sizes = groups.agg(*[F.coalesce(F.sum(layer), F.lit(0)).alias(layer) for layer in ("raw", "quarantine", "unpriced")],
                       F.count_if(F.col("priced") > 0).alias("silver"))
    return sizes.unpivot([], sizes.columns, "layer", "row_count")


def clean_orders(flagged: DataFrame, signature: list[str],
                 required: tuple[str, ...] = ("quantity", "unit_price")) -> DataFrame:
    """Accepted rows, one per signature, with standardised status and payment method.

    Copies fold by aggregation; of their lineage columns the smallest is kept,
    so a recomputed task gives the same row again.
    """
    kept = accepted_orders(flagged).dropna(subset=list(required))
    lineage = [c for c in kept.columns if c not in signature]
    single = kept.dropDuplicates() if not lineage else (
        kept.groupBy(*signature).agg(F.min(F.struct(*lineage)).alias("lineage"))
        .select(*signature, "lineage.*"))
    return single.withColumns({
        "status": tidy_lower("status"),
        "payment_method": F.coalesce(tidy_lower("payment_method"), F.lit(NO_PAYMENT)),
    })
