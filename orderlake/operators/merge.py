"""Keyed upsert and slowly changing history as DataFrame algebra."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions import all_present, any_differs, is_true, moment


def unique_or_fail(batch: DataFrame, keys: list[str]) -> DataFrame:
    """``batch`` itself; running it fails when two of its rows share a non-NULL key.

    The check is one aggregate whose single result guards the scan, so no row is
    shuffled for it except the key columns.
    """
    message = "more than one batch row per key (" + ", ".join(keys) + ")"
    repeated = (batch.where(all_present(keys)).groupBy(*keys)
                .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    verdict = repeated.agg(
        F.when(F.count(F.lit(1)) > 0, F.raise_error(F.lit(message)).cast("boolean"))
        .otherwise(F.lit(True)).alias("is_unique"))
    return batch.where(verdict.scalar())


def one_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct non-NULL keys, as the right side of a lookup join.

    Grouping by the keys alone would leave this side partitioned for the join
    already.  Adaptive execution splits a heavy key of the other side only where
    both sides come straight from a shuffle, so the grouping takes one more
    column and the join gets a shuffle of its own for these few, narrow rows.
    """
    named = rows.select(*keys).where(all_present(keys))
    return named.withColumn("key_hash", F.hash(*keys)).distinct().select(*keys)


def replace_key_groups(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Drop the target rows whose key occurs in ``source``, then add all source rows.

    Works for keys with many rows, and applying the same source twice changes
    nothing.  A NULL key matches nothing: its rows stay and are added again.
    """
    return (target.join(one_per_key(source, keys), keys, "left_anti")
            .unionByName(source, allowMissingColumns=True))


def key_fates(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The non-NULL keys of ``target``, and whether each ``stays`` when ``source`` replaces its key groups.

    Neither side of the join repeats a key, so it takes the shuffle that the keys are told apart by.
    """
    held, brought = (rows.select(*keys).where(all_present(keys)).distinct() for rows in (target, source))
    return (held.join(brought.withColumn("is_brought", F.lit(True)), keys, "left")
            .select(*keys, F.col("is_brought").isNull().alias("stays")))


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Update or insert by a key that must be unique in ``source``."""
    return replace_key_groups(target, unique_or_fail(source, keys), keys)


# --- history -----------------------------------------------------------------

def open_versions(batch: DataFrame) -> DataFrame:
    """Batch rows as current versions, valid from their load date."""
    return batch.withColumns({
        "is_current": F.lit(True),
        "valid_from": F.col("ingest_date").cast("date"),
        "valid_to": F.lit(None).cast("timestamp"),
    })


def current_versions(history: DataFrame) -> DataFrame:
    return history.where(is_true(F.col("is_current")))


def closed_versions(history: DataFrame) -> DataFrame:
    return history.where(~is_true(F.col("is_current")))


def match_versions(history: DataFrame, batch: DataFrame, keys: list[str], tracked: list[str],
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """Current versions that the batch has a row for: key, ``carry`` columns and whether it ``changes``.

    The one pass over the history; it reads only key, tracked and carried columns.
    """
    now = current_versions(history).select(*keys, *tracked, *carry).alias("now")
    new = batch.select(*keys, *tracked).alias("new")
    return (now.join(new, [F.col(f"now.{k}") == F.col(f"new.{k}") for k in keys])
            .select(*[F.col(f"now.{c}") for c in (*keys, *carry)],
                    any_differs("now", "new", tracked).alias("changes")))


def arrivals(history: DataFrame, batch: DataFrame, keys: list[str], tracked: list[str],
             carry: tuple[str, ...] = ()) -> DataFrame:
    """Keys of the batch rows that are new or change a current version: key, its ``carry`` columns, ``changes``.

    Reads what :func:`match_versions` reads, and needs one current version per
    key.  Rows with a NULL key are new and left out.
    """
    now = current_versions(history).select(*keys, *tracked, *carry, F.lit(True).alias("is_held")).alias("now")
    new = batch.where(all_present(keys)).select(*keys, *tracked).alias("new")
    changes = any_differs("now", "new", tracked)
    return (new.join(now, [F.col(f"now.{k}") == F.col(f"new.{k}") for k in keys], "left")
            .where(F.col("is_held").isNull() | changes)
            .select(*[F.col(f"new.{k}") for k in keys], *[F.col(f"now.{c}") for c in carry], changes.alias("changes")))


def arriving_rows(batch: DataFrame, arrivals: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows that :func:`arrivals` names, and those with a NULL key."""
    return batch.where(~all_present(keys)).unionByName(batch.join(arrivals.select(*keys), keys, "left_semi").select(*batch.columns))


def changed_keys(matches: DataFrame, keys: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """Keys whose current version the batch closes."""
    return matches.where("changes").select(*keys, *carry).distinct()


def fresh_rows(batch: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows that no current version survives for: changed keys, new keys and NULL keys."""
    return batch.join(one_per_key(matches.where("NOT changes"), keys), keys, "left_anti")


def close_versions(history: DataFrame, changed: DataFrame, keys: list[str], as_of: str) -> DataFrame:
    """The whole history, with the current versions of the ``changed`` keys closed at ``as_of``.

    No row of the history is multiplied, and a key with many rows can be split
    on the history side of the join.
    """
    marks = one_per_key(changed, keys).withColumn("closes_now", F.lit(True))
    ends_now = F.col("closes_now")
    now_closed = (current_versions(history).join(marks, keys, "left")
                  .withColumns({
                      "is_current": ends_now.isNull(),
                      "valid_to": F.when(ends_now, moment(as_of)).otherwise(F.col("valid_to")),
                  })
                  .select(*history.columns))
    return now_closed.unionByName(closed_versions(history))


def merge_history(history: DataFrame, batch: DataFrame, keys: list[str], tracked: list[str],
                  as_of: str) -> DataFrame:
    """Close what changed, then add the new current versions; batch keys must be unique."""
    batch = unique_or_fail(batch, keys)
    matches = match_versions(history, batch, keys, tracked)
    fresh = open_versions(fresh_rows(batch, matches, keys))
    return (close_versions(history, changed_keys(matches, keys), keys, as_of)
            .unionByName(fresh, allowMissingColumns=True))
