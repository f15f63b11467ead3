"""Copies and conflicts.

A key or a signature may own a large share of all rows, so nothing here ranks
or counts inside a window.  Groups are reduced by map-side aggregation first;
what was found comes back to the rows by :func:`mark_rows`, which never sends a
heavy group to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions import all_present, not_positive_or_missing


def mark_rows(rows: DataFrame, groups: DataFrame, keys: list[str], mark: str) -> DataFrame:
    """Add the boolean ``mark`` that ``groups`` holds per key; rows of other keys get false.

    ``groups`` has one row per key, so adaptive execution can split the rows of
    any number of heavy keys, or send the groups to the rows where they are
    small.  Rows with a NULL key match nothing; they are routed by the number of
    the task they come from, which spreads them and is the same on every attempt.
    """
    routed = rows.withColumn("route", F.when(all_present(keys), F.lit(-1)).otherwise(F.spark_partition_id()))
    marked = groups.where(F.col(mark)).select(*keys, F.lit(-1).alias("route"), F.lit(True).alias("group_mark"))
    return (routed.join(marked, [*keys, "route"], "left")
            .select(*rows.columns, F.coalesce("group_mark", F.lit(False)).alias(mark)))


# --- conflicts: one key, several contents ----------------------------------------

def repeated_key_stats(rows: DataFrame, key: str, signature: list[str]) -> DataFrame:
    """Keys with several rows: ``key, dup_count, distinct_row_count``.

    Grouping by the whole signature first folds exact copies and spreads a hot
    key over all tasks; the second grouping sees one partial row per key and task.
    NULLs inside a signature compare equal; rows without a key are left out.
    """
    signatures = (rows.where(F.col(key).isNotNull())
                  .groupBy(*signature).agg(F.count(F.lit(1)).alias("copies")))
    return (signatures.groupBy(key)
            .agg(F.sum("copies").alias("dup_count"), F.count(F.lit(1)).alias("distinct_row_count"))
            .where(F.col("dup_count") > 1))


def conflicting_keys(rows: DataFrame, key: str, signature: list[str]) -> DataFrame:
    """Keys with at least two different signatures."""
    return repeated_key_stats(rows, key, signature).where(F.col("distinct_row_count") > 1)


def flag_orders(rows: DataFrame, key: str, signature: list[str],
                repeated: DataFrame | None = None) -> DataFrame:
    """Add ``is_conflicting``, ``is_invalid_quantity`` and ``is_invalid_date``.

    ``repeated`` (see :func:`repeated_key_stats`) may be passed in when it was
    already written to a table: Spark then knows its size before planning and,
    if it is small, need not shuffle ``rows`` at all.
    """
    if repeated is None:
        repeated = repeated_key_stats(rows, key, signature)
    stats = repeated.withColumn("is_conflicting", F.col("distinct_row_count") > 1)
    return (mark_rows(rows, stats, [key], "is_conflicting")
            .withColumns({
                "is_invalid_quantity": not_positive_or_missing("quantity"),
                "is_invalid_date": F.col("order_date").isNull(),
            }))


# --- copies: one content, several rows ---------------------------------------------

def repeated_signatures(rows: DataFrame, signature: list[str]) -> DataFrame:
    """Fully present signatures that occur more than once."""
    return (rows.where(all_present(signature))
            .groupBy(*signature).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def suspect_hashes(rows: DataFrame, signature: list[str]) -> DataFrame:
    """Hashes shared by two or more rows: equal rows always share one, so nothing is missed.

    Shuffles eight bytes per row instead of the signature.  Unequal rows may
    collide, so the result only narrows the input of :func:`repeated_signatures`.
    """
    return (rows.where(all_present(signature))
            .groupBy(F.xxhash64(*signature).alias("signature_hash"))
            .agg(F.count(F.lit(1)).alias("hits"))
            .where(F.col("hits") > 1)
            .select("signature_hash"))


def suspect_parts(rows: DataFrame, signature: list[str]) -> DataFrame:
    """As :func:`suspect_hashes`, by the first 34 and the last 6 bits of each hash, which is all that its words need.

    The forty bits lie side by side in what is shuffled, so that its other bytes fold away.
    """
    whole = F.xxhash64(*signature)
    part = whole.bitwiseAND(F.lit(-1 << 30)).bitwiseOR(F.shiftleft(whole.bitwiseAND(F.lit(63)), 24))
    return (rows.where(all_present(signature))
            .groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("hits"))
            .where(F.col("hits") > 1)
            .select(F.col("part").bitwiseAND(F.lit(-1 << 30))
                    .bitwiseOR(F.shiftright("part", 24).bitwiseAND(F.lit(63))).alias("signature_hash")))


def suspect_words(suspects: DataFrame) -> DataFrame:
    """The hashes of :func:`suspect_hashes` as bits: ``_word`` (19 bits of a hash) and its 64 ``_bits`` (6 more).

    At most 524,288 rows of 12 bytes, however many suspects there are, so rows can be
    held against it without a shuffle of their own.  What is more than that is lost
    in precision alone: rows of other hashes then pass for suspects as well.
    """
    bit = F.expr("shiftleft(1L, cast(signature_hash & 63 AS int))")
    return suspects.groupBy(_word_of("signature_hash").alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def _word_of(name: str) -> Column:
    return F.shiftrightunsigned(name, 45).cast("int")


def tell_suspects(rows: DataFrame, signature: list[str], words: DataFrame) -> DataFrame:
    """Add ``_is_suspect``: true for every fully present signature that may occur more than once.

    ``words`` (see :func:`suspect_words`) are bounded in number, so each task is sent them whatever the session
    takes for small: rows are never shuffled for this.
    """
    hashed = rows.withColumn("_signature_hash", F.xxhash64(*signature))
    hashed = hashed.withColumn("_word", _word_of("_signature_hash"))
    hit = F.getbit("_bits", F.col("_signature_hash").bitwiseAND(F.lit(63)).cast("int")) == 1
    return (hashed.join(F.broadcast(words), "_word", "left")
            .select(*rows.columns, (all_present(signature) & F.coalesce(hit, F.lit(False))).alias("_is_suspect")))


def narrow_to_suspects(rows: DataFrame, signature: list[str], suspects: DataFrame) -> DataFrame:
    """Rows whose signature hash is a suspect one."""
    return (rows.withColumn("signature_hash", F.xxhash64(*signature))
            .join(suspects, "signature_hash", "left_semi")
            .drop("signature_hash"))


def flag_copies(rows: DataFrame, signature: list[str], repeated: DataFrame | None = None) -> DataFrame:
    """Add ``has_one_copy``: the signature is fully present and no other row shares it.

    ``repeated`` (see :func:`repeated_signatures`) may be passed in from a table.
    """
    if repeated is None:
        repeated = repeated_signatures(rows, signature)
    groups = repeated.withColumn("is_repeated", F.lit(True))
    return (mark_rows(rows, groups, signature, "is_repeated")
            .withColumn("has_one_copy", all_present(signature) & ~F.col("is_repeated"))
            .drop("is_repeated"))
