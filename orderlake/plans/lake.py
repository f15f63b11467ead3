"""What the two pipelines share: tables, staging, and batch-wise writes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.contracts import widened
from orderlake.functions import all_present
from orderlake.operators import audit, duplicates, layout, merge
from orderlake.sources.ledgers import REPORTED, ColumnLedger, FileLedger, LayerLog, PartitionLedger, StageLog
from orderlake.sources.runlog import RunLog
from orderlake.sources.tables import LakeTable, Stage


#: A task that reads rows of no more load dates than these writes a file of each; of more, they are rebalanced first.
FEW_DAYS = 4
#: Of a first delivery, the rows that tell whether it has few load dates; its layout depends on it, never its rows.
FIRST_ROWS = 10_000


def values_of(rows: DataFrame, column: str) -> list:
    """The distinct values of a partition column in a batch.

    They come to the driver on purpose: it is the list of partition folders that
    the driver has to create or swap at commit anyway, and as literals they let
    Spark leave all other partitions unread.
    """
    return [row[0] for row in rows.select(column).distinct().collect()]


def first_values(rows: DataFrame, column: str) -> list:
    """The distinct values among the first rows, without reading the others."""
    return values_of(rows.select(column).limit(FIRST_ROWS), column)


def rows_per(rows: DataFrame, column: str) -> dict:
    """Row count per value of a partition column; as many entries as there are folders to touch."""
    return {row[0]: row[1] for row in rows.groupBy(column).agg(F.count(F.lit(1))).collect()}


def in_partitions(column: str | Column, values: list) -> Column:
    """Rows of the named partitions, NULL included when it is one of them."""
    column = F.col(column) if isinstance(column, str) else column
    named = [v for v in values if v is not None]
    condition = column.isin(named) if named else F.lit(False)
    return condition | column.isNull() if None in values else condition


class Lake:
    """A root folder with layered tables, a run log and a staging folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.stage = Stage(spark, f"{self.root}/_stage")
        self.log = RunLog(spark, f"{self.root}/run_log")
        self.batches = PartitionLedger(spark, f"{self.root}/ledger/partitions")
        self.files = FileLedger(spark, f"{self.root}/ledger/files")
        self.columns = ColumnLedger(spark, f"{self.root}/ledger/columns")
        self.stages = StageLog(spark, f"{self.root}/ledger/stages")
        self.times: list[tuple] = []
        self.layers = LayerLog(spark, f"{self.root}/ledger/layers")
        self.sizes: list[tuple[str, int, str]] = []
        #: Columns beyond the contract that deliveries have brought so far.
        self.extra = self.columns.read()

    def tables(self) -> dict[str, LakeTable]:
        return {name: item for name, item in vars(self).items() if isinstance(item, LakeTable)}

    def table(self, path: str, **options) -> LakeTable:
        return LakeTable(self.spark, f"{self.root}/{path}", **options)

    @contextmanager
    def timed(self, stage: str, as_of: str) -> Iterator[None]:
        """Keep the times of a stage of a run that ended well; ``end_run`` writes them to the stage log."""
        started = dt.datetime.now(dt.timezone.utc)
        yield
        self.times.append((stage, started, dt.datetime.now(dt.timezone.utc), as_of))

    def counted(self, rows: DataFrame, name: str, layers: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
        """Write ``rows`` aside, and count in that same pass the rows that each layer's condition holds for.

        The counts are those of the write's own committed tasks, so a repeated
        task is counted once.
        """
        counter = Observation()
        observed = rows.observe(counter, *[F.count_if(condition).alias(layer) for layer, condition in layers.items()])
        kept = self.stage.keep(observed, name)
        return kept, {layer: counter.get[layer] for layer in layers}

    def keep_counted(self, rows: DataFrame, name: str, layers: dict[str, Column], as_of: str) -> DataFrame:
        """As :meth:`counted`; ``end_run`` writes the counts to the layer log."""
        kept, counts = self.counted(rows, name, layers)
        self.sizes += [(layer, count, as_of) for layer, count in counts.items()]
        return kept

    # --- columns beyond the contract ----------------------------------------------

    def admit(self, rows: DataFrame, found: list[str], as_of: str) -> DataFrame:
        """Note a delivery's new columns, and give its rows all the columns that the lake has by now."""
        known = {name.lower(): name for name in self.extra}
        fresh = [name for name in found if name.lower() not in known]
        if fresh:
            self.columns.note(len(self.extra), fresh, as_of)
            self.extra = [*self.extra, *fresh]
            self.declare()
        rows = rows.withColumnsRenamed({name: known[name.lower()] for name in found if name.lower() in known})
        have = set(rows.columns)
        return rows.withColumns({name: F.lit(None).cast("string") for name in self.extra if name not in have})

    def declare(self) -> None:
        """Set the schemas of the tables that carry the further columns; set by each pipeline."""
        for table, schema in self.carriers():
            table.schema = widened(schema, self.extra)

    def carriers(self) -> list[tuple[LakeTable, T.StructType]]:
        """The tables that carry further columns, with their contracts."""
        return []

    # --- writes, each with its line in the run log ----------------------------

    def append(self, table: LakeTable, rows: DataFrame, as_of: str, as_read: bool = False) -> int:
        return self._logged(table, "append", table.append(rows, as_read), as_of)

    def publish(self, table: LakeTable, rows: DataFrame, as_of: str, operation: str = "overwrite") -> int:
        return self._logged(table, operation, table.publish(rows), as_of)

    def replace_partitions(self, table: LakeTable, rows: DataFrame, as_of: str, operation: str,
                           as_read: bool = False) -> int:
        return self._logged(table, operation, table.replace_partitions(rows, as_read), as_of)

    def _logged(self, table: LakeTable, operation: str, row_count: int, as_of: str) -> int:
        self.log.record(table.path.removeprefix(self.root + "/"), operation, row_count, as_of)
        return row_count

    def partition_type(self, table: LakeTable) -> T.DataType:
        return table.schema[table.partition_by[0]].dataType

    def note_touched(self, table: LakeTable, values: list, as_of: str) -> None:
        self.batches.note(table.path.removeprefix(self.root + "/"), values, as_of)

    def touched_before(self, table: LakeTable, as_of: str) -> list:
        return self.batches.of_batch(table.path.removeprefix(self.root + "/"), as_of, self.partition_type(table))

    def write_batch(self, table: LakeTable, rows: DataFrame, mine: Column, as_of: str) -> None:
        """Add a batch's rows; when the batch ran before, its former rows (``mine``) make way.

        The partitions that the batch wrote to before are known from the ledger, so
        that only these and the ones it brings now are read and replaced, and none
        keeps a row that the batch no longer brings.
        """
        partition = table.partition_by[0]
        days = values_of(rows, partition)
        former = self.touched_before(table, as_of)
        self.note_touched(table, [v for v in days if v not in former], as_of)
        as_read = len({*days, *former}) <= FEW_DAYS
        if not table.exists():
            if days:
                self.append(table, rows, as_of, as_read)
            return
        held = table.read().where(in_partitions(partition, list({*days, *former})))
        if held.where(mine).isEmpty():
            if days:
                self.append(table, rows, as_of, as_read)
            return
        others = held.where(~F.coalesce(mine, F.lit(False)))
        kept = rows_per(others, partition)
        self.replace_partitions(table, others.unionByName(rows, allowMissingColumns=True), as_of, "replace batch", as_read)
        table.drop_partitions([v for v in former if v not in days and v not in kept])

    # --- upsert ---------------------------------------------------------------

    def unique(self, batch: DataFrame, keys: list[str]) -> DataFrame:
        """``batch`` itself, after it was looked through once for rows that share a key; fails when some do.

        Eight bytes per row are shuffled; the keys themselves only where these meet.
        """
        suspects = self.stage.keep(duplicates.suspect_hashes(batch, keys), "suspect_keys")
        if not suspects.isEmpty():
            merge.unique_or_fail(duplicates.narrow_to_suspects(batch, keys, suspects), keys).select(*keys).isEmpty()
        return batch

    def replaced(self, held: DataFrame, source: DataFrame, keys: list[str], name: str,
                 brought: DataFrame | None = None) -> DataFrame:
        """As :func:`merge.replace_key_groups`, by the keys that stay or those that go, whichever are fewer.

        Which keys stay is found from the key columns alone.  The rows held are
        then looked up among the fewer ones, which are written aside: most
        deliveries bring few of the keys held, or nearly all, and no row is shuffled then.
        ``brought``, the keys of ``source``, may be passed in from a table.
        """
        fates = self.stage.keep(merge.key_fates(held, source if brought is None else brought, keys), f"{name}_fates")
        counts = rows_per(fates, "stays")
        by_stays = counts.get(True, 0) <= counts.get(False, 0)
        fewer = self.stage.keep(fates.where(F.col("stays") == by_stays).select(*keys), f"{name}_fewer")
        if not by_stays:
            kept = held.join(fewer, keys, "left_anti")
        else:
            kept = held.where(~all_present(keys)).unionByName(held.join(fewer, keys, "left_semi"))
        return kept.unionByName(source, allowMissingColumns=True)

    def upsert(self, table: LakeTable, source: DataFrame, keys: list[str], as_of: str) -> None:
        """Replace the key groups that ``source`` brings; adds only, where it brings none the table has.

        A first pass over key and partition columns finds the partitions that
        lose or gain rows, and only those are rewritten.  Folders of partitions
        that lose their last row are deleted after that; a run that stops in
        between is completed by running it again.  Bronze sources may repeat a
        key; where keys have to be unique, the caller checks before.
        """
        if not table.partition_by:
            if table.exists():
                self.publish(table, merge.replace_key_groups(table.read(), source, keys), as_of, "upsert")
            else:
                self.append(table, source, as_of)
            return
        partition = table.partition_by[0]
        arriving = rows_per(source, partition)
        if not table.exists():
            self.note_touched(table, list(arriving), as_of)
            self.append(table, source, as_of)
            return
        stored = table.read()
        held = stored.select(*{*keys, partition})
        leaving = rows_per(held.join(merge.one_per_key(source, keys), keys, "left_semi"), partition)
        self.note_touched(table, list({*leaving, *arriving}), as_of)
        if not leaving:
            self.append(table, source, as_of)
            return
        part = stored.where(in_partitions(partition, list({*leaving, *arriving})))
        before = rows_per(part, partition)
        emptied = [value for value, count in leaving.items()
                   if count == before[value] and value not in arriving]
        self.replace_partitions(table, self.replaced(part, source, keys, table.name), as_of, "upsert")
        table.drop_partitions(emptied)

    # --- history --------------------------------------------------------------

    def met(self, history: DataFrame, batch: DataFrame, keys: list[str], name: str) -> DataFrame:
        """The rows of a history whose key a batch may bring: all that it does bring, and few others.

        The hashes of the batch's keys are folded into bits of a bounded number, which every task gets, so most
        rows of other keys are left out before any is shuffled.  The more bits a batch sets, the fewer are.
        """
        brought = batch.where(all_present(keys)).select(
            F.xxhash64(*[F.col(k).cast(history.schema[k].dataType) for k in keys]).alias("signature_hash"))
        words = self.stage.keep(duplicates.suspect_words(brought), f"{name}_words")
        return duplicates.tell_suspects(history, keys, words).where("_is_suspect").drop("_is_suspect")

    def merge_history(self, table: LakeTable, batch: DataFrame, keys: list[str], tracked: list[str],
                      as_of: str) -> None:
        """Bring a clean batch, which the run has written aside, into a history table.

        One pass over the key and tracked columns of the history finds the batch
        rows that are new or change a version; those that change nothing are not
        written aside.  Only partitions where a version closes are
        then rewritten, first; the others get their new rows as further files.
        Closed versions stay in their partition, so none can become empty and be missed.
        """
        batch = self.unique(batch, keys)
        if not table.exists():
            if table.partition_by:
                self.note_touched(table, values_of(batch, table.partition_by[0]), as_of)
            self.append(table, merge.open_versions(batch), as_of)
            return
        history = table.read()
        carry = table.partition_by[:1]
        held = self.met(merge.current_versions(history), batch, keys, table.name)
        arrivals = self.stage.keep(merge.arrivals(held, batch, keys, tracked, carry), f"{table.name}_arrivals")
        changed = merge.changed_keys(arrivals, keys, carry)
        fresh = self.stage.keep(merge.open_versions(merge.arriving_rows(batch, arrivals, keys)), f"{table.name}_fresh")
        if not carry:
            merged = merge.close_versions(history, changed, keys, as_of).unionByName(fresh)
            self.publish(table, merged, as_of, "merge history")
            return
        partition = carry[0]
        closing, opening = values_of(changed, partition), values_of(fresh, partition)
        added = [value for value in opening if value not in closing]
        self.note_touched(table, [*closing, *added], as_of)
        written = 0
        if closing:
            part = history.where(in_partitions(partition, closing))
            merged = merge.close_versions(part, changed, keys, as_of)
            written += table.replace_partitions(merged.unionByName(fresh.where(in_partitions(partition, closing))))
        if added:
            written += table.append(fresh.where(in_partitions(partition, added)))
        if written:
            self._logged(table, "merge history", written, as_of)

    # --- gold, a part at a time ---------------------------------------------------

    def to_report(self, source: LakeTable, as_of: str, *reports: LakeTable) -> list | None:
        """The partitions of ``source`` that reports have to be brought up to date with; None for all."""
        if not all(table.exists() for table in reports):
            return None
        return self.batches.unreported(source.path.removeprefix(self.root + "/"), as_of, self.partition_type(source))

    def refresh(self, table: LakeTable, rows: DataFrame, values: list | None, as_of: str,
                named: DataFrame | None = None) -> None:
        """Make ``rows`` the content of these partitions of ``table``; of all, if ``values`` is None.

        ``named`` has the same partition values as ``rows`` and is cheaper to look through; without it these
        are written aside.
        """
        if values is None:
            self.publish(table, rows, as_of)
        elif values:
            partition = table.partition_by[0]
            if named is None:
                named = rows = self.stage.keep(rows, f"{table.name}_part")
            present = values_of(named, partition)
            self.replace_partitions(table, rows, as_of, "refresh")
            table.drop_partitions([v for v in values if v not in present])

    def refresh_where(self, table: LakeTable, rows: DataFrame, part: Column, values: list | None, as_of: str) -> None:
        """The same for a small table without partitions, whose parts are told by ``part``."""
        if values is None:
            self.publish(table, rows, as_of)
        elif values:
            others = table.read().where(~F.coalesce(in_partitions(part, values), F.lit(False)))
            self.publish(table, others.unionByName(rows), as_of, "refresh")

    def reported(self, as_of: str) -> None:
        """Note that all reports of a batch are complete."""
        self.batches.note(REPORTED, [None], as_of)

    def end_run(self) -> None:
        """Write the times of its stages and the sizes of its layers, and drop what the run wrote aside."""
        self.stages.note(self.times)
        self.layers.note(self.sizes)
        self.times, self.sizes = [], []
        self.stage.clear()
        self.stage = Stage(self.spark, f"{self.root}/_stage")

    # --- reports --------------------------------------------------------------

    def existing(self) -> dict[str, LakeTable]:
        return {name: table for name, table in self.tables().items() if table.exists()}

    def health(self) -> DataFrame:
        """Files and bytes of every table, from the file listing."""
        return layout.table_health(self.spark, {n: t.location() for n, t in self.existing().items()})

    def row_counts(self) -> DataFrame:
        return audit.layer_counts({n: t.read() for n, t in self.existing().items()})

    def history_log(self) -> DataFrame:
        return self.log.read()
