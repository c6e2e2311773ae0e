"""A versioned index with tombstones, fed from a change log."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventlake.operators.heavy import first_per_key
from eventlake.operators.joins import checked_broadcast
from eventlake.operators.mergetable import MergeTable, fold
from eventlake.sources.schemas import CHECKPOINT, INDEX_RECORD, record
from eventlake.sources.tables import read_dataset

RECORD_KEY = ["dataset", "record_id"]
BATCH_PER_DATASET = 200
RECENT_SECONDS = 600


def pending_changes(log: DataFrame, checkpoints: DataFrame,
                    datasets: Sequence[str] | None = None) -> DataFrame:
    """Log rows beyond the checkpoint of their dataset; no checkpoint means from the start."""
    if datasets is not None:
        log = log.where(F.col("dataset").isin(*datasets))
        checkpoints = checkpoints.where(F.col("dataset").isin(*datasets))
    progress = checked_broadcast(checkpoints.select("dataset", "last_offset"))
    return log.join(progress, "dataset", "left") \
        .where(F.col("offset") > F.coalesce("last_offset", F.lit(0))).drop("last_offset")


def next_increment(log: DataFrame, checkpoints: DataFrame, limit: int = BATCH_PER_DATASET,
                   datasets: Sequence[str] | None = None) -> DataFrame:
    """The ``limit`` lowest pending offsets of every dataset."""
    return first_per_key(pending_changes(log, checkpoints, datasets), "dataset", "offset", limit)


def _rank(order_by: str) -> Column:
    """What the winning change of a record is greatest by."""
    if order_by == "version":
        return F.struct(F.col("version"), (-F.col("offset")).alias("first_seen"))
    if order_by == "offset":
        return F.struct(F.col("offset"), F.col("version"))
    raise ValueError(f"order_by must be 'version' or 'offset', not {order_by!r}")


def index_rows(changes: DataFrame, indexed_at: Column, order_by: str = "version") -> DataFrame:
    """The index row each record of ``changes`` ends with.

    By ``version`` (the default) the first change of the greatest version wins, as if the changes
    were applied one by one under a strictly-greater gate. A record re-created after a delete starts
    again at version 1 and then loses to its tombstone; ``order_by="offset"`` lets the last change
    win instead.
    """
    # Only versions above 0 pass the gate of a record that is not indexed yet.
    gated = changes.where(F.col("version") > 0) if order_by == "version" else changes
    upsert = F.col("op") == "upsert"
    return gated.groupBy(*RECORD_KEY).agg(F.max_by(
        F.struct(F.when(upsert, F.coalesce("payload", F.lit(""))).alias("payload"), "version",
                 indexed_at.alias("indexed_at"),
                 F.when(upsert, 0).otherwise(1).alias("tombstone"), "offset"),
        _rank(order_by)).alias("last")).select(*RECORD_KEY, "last.*")


def apply_changes(index: DataFrame, changes: DataFrame, indexed_at: Column) -> DataFrame:
    """The index after a batch of changes; a stored row wins against an equal version."""
    stored = index.select(*INDEX_RECORD.names).withColumn("stored", F.lit(1))
    fresh = index_rows(changes, indexed_at).select(*INDEX_RECORD.names).withColumn("stored", F.lit(0))
    return fold(stored.unionByName(fresh), RECORD_KEY, ["version", "stored"]).drop("stored")


def progress(changes: DataFrame) -> DataFrame:
    """Highest offset and event time and number of changes per dataset."""
    return changes.groupBy("dataset").agg(
        F.max("offset").alias("last_offset"), F.max("event_ts").alias("last_event_ts"),
        F.count(F.lit(1)).alias("processed"))


def advance_checkpoints(checkpoints: DataFrame, changes: DataFrame, updated_at: Column) -> DataFrame:
    """Checkpoints after a batch: both marks only move forward; untouched datasets stay as they are."""
    moved = progress(changes).select("dataset", "last_offset", "last_event_ts",
                                     updated_at.cast("long").alias("updated_at"))
    return checkpoints.select(*CHECKPOINT.names).unionByName(moved).groupBy("dataset").agg(
        *[F.max(c).alias(c) for c in ("last_offset", "last_event_ts", "updated_at")])


def set_checkpoint(checkpoints: DataFrame, dataset: str, offset: int, updated_at: Column) -> DataFrame:
    """Move one dataset's checkpoint to ``offset`` (for a replay) and forget its event time."""
    others = checkpoints.select(*CHECKPOINT.names).where(F.col("dataset") != F.lit(dataset))
    moved = checkpoints.sparkSession.range(1).select(
        F.lit(dataset).alias("dataset"), F.lit(offset).cast("long").alias("last_offset"),
        F.lit(0).cast("long").alias("last_event_ts"), updated_at.cast("long").alias("updated_at"))
    return others.unionByName(moved)


def source_index_rows(source: DataFrame, dataset: str, indexed_at: Column) -> DataFrame:
    """Index rows of one dataset taken straight from its source-of-truth records."""
    return read_dataset(source, dataset).select(
        *RECORD_KEY, "payload", "version", indexed_at.cast("long").alias("indexed_at"),
        F.lit(0).alias("tombstone"))


def rebuild(index: DataFrame, source: DataFrame, dataset: str, indexed_at: Column) -> DataFrame:
    """The index with one dataset replaced by its source records; its tombstones vanish."""
    others = index.select(*INDEX_RECORD.names).where(F.col("dataset") != F.lit(dataset))
    return others.unionByName(source_index_rows(source, dataset, indexed_at))


def recent_changes(index: DataFrame, as_of_s: int, seconds: int = RECENT_SECONDS) -> DataFrame:
    """Index rows written within the last ``seconds``."""
    return index.where(F.col("indexed_at") >= F.lit(as_of_s - seconds))


ROW_PART, CONTROL_PART = "rows", "control"


class IndexStore:
    """The stored form: index rows and control rows (checkpoints) in one table, in folders of their own.

    A rebuild writes the source rows of its dataset under the next epoch and then moves the control
    row to it. Rows of earlier epochs no longer count, so no other dataset is rewritten. A replay
    also opens a new epoch, because its checkpoint goes back, but keeps the rows.
    """

    ROWS = T.StructType([*INDEX_RECORD.fields, *record(offset="long", epoch="long").fields])
    CONTROL = T.StructType([*CHECKPOINT.fields, *record(epoch="long", rows_epoch="long").fields])

    def __init__(self, spark: SparkSession, root: str, order_by: str = "version"):
        self.spark, self.order_by = spark, order_by
        # Rows and control rows of a batch are one write, so the one is never there without the other.
        self.table = MergeTable(spark, f"{root}/index", record(row=self.ROWS, control=self.CONTROL, part="string"), [], [],
                                finish=self._finished, part="part")

    def checkpoints(self) -> DataFrame:
        return self._control().select(*CHECKPOINT.names)

    def index(self) -> DataFrame:
        """Current index rows, tombstones included."""
        return self._merged().select(*INDEX_RECORD.names)

    def apply_batch(self, changes: DataFrame, as_of_s: int, run: str, batch_id: int) -> None:
        """Store a batch of change-log rows; the version gate is resolved when the index is read."""
        now = F.lit(as_of_s).cast("long")
        changes = changes.persist()
        try:
            moved = self._tag(progress(changes).withColumn("updated_at", now)).withColumn(
                "last_event_ts", F.greatest("last_event_ts", "known_event_ts"))
            self._write(self._tag(index_rows(changes, now, self.order_by)), moved, run, batch_id)
        finally:
            changes.unpersist()

    def rebuild(self, source: DataFrame, dataset: str, as_of_s: int) -> None:
        """Replace one dataset by its source records and restart its checkpoint."""
        now = F.lit(as_of_s).cast("long")
        epoch = self._epoch(dataset) + 1
        rows = source_index_rows(source, dataset, now).withColumns(
            {"offset": F.lit(0).cast("long"), "epoch": F.lit(epoch).cast("long")})
        self._write(rows, self._restart(dataset, 0, now, epoch, F.lit(epoch)),
                    self._admin_run("rebuild", dataset), epoch)

    def replay(self, dataset: str, offset: int, as_of_s: int) -> None:
        """Let the next run read one dataset again from beyond ``offset``."""
        control = self._control().where(F.col("dataset") == F.lit(dataset)).first()
        rows_epoch, epoch = (control["rows_epoch"], control["epoch"] + 1) if control else (0, 1)
        moved = self._restart(dataset, offset, F.lit(as_of_s).cast("long"), epoch, F.lit(rows_epoch))
        self._write(None, moved, self._admin_run("replay", dataset), epoch)

    def compact(self) -> None:
        self.table.compact()

    def _finished(self, batch: DataFrame) -> DataFrame:
        """Per record and epoch the row that counts, per dataset the control row that does."""
        rows = self._last_of(batch.where(F.col("part") == ROW_PART).select("row.*"), [*RECORD_KEY, "epoch"])
        return self._paired(rows, self._last_control(batch))

    @staticmethod
    def _last_control(batch: DataFrame) -> DataFrame:
        return fold(batch.where(F.col("part") == CONTROL_PART).select("control.*"), ["dataset"], ["epoch", "last_offset"])

    def _last_of(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return fold(rows.withColumn("rank", _rank(self.order_by)), keys, ["rank"]).drop("rank")

    def _control(self) -> DataFrame:
        return self._last_control(self.table.batches())

    def _paired(self, rows: DataFrame | None, control: DataFrame) -> DataFrame:
        none = {name: F.lit(None).cast(kind) for name, kind in (("row", self.ROWS), ("control", self.CONTROL))}
        both = control.select(none["row"].alias("row"), F.struct(*self.CONTROL.names).alias("control"),
                              F.lit(CONTROL_PART).alias("part"))
        if rows is not None:
            both = both.unionByName(rows.select(F.struct(*self.ROWS.names).alias("row"), none["control"].alias("control"),
                                                F.lit(ROW_PART).alias("part")))
        return both

    def _write(self, rows: DataFrame | None, control: DataFrame, run: str, batch_id: int) -> None:
        self.table.write(self._paired(rows, control), run, batch_id)

    def _merged(self) -> DataFrame:
        control = checked_broadcast(self._control().select("dataset", "rows_epoch"))
        rows = self.table.batches().where(F.col("part") == ROW_PART).select("row.*").join(control, "dataset", "left") \
            .where(F.col("epoch") >= F.coalesce("rows_epoch", F.lit(0))).drop("rows_epoch")
        return self._last_of(rows, RECORD_KEY)

    def _tag(self, rows: DataFrame) -> DataFrame:
        """Add the epoch the dataset of each row is in."""
        control = checked_broadcast(self._control().select(
            "dataset", "epoch", "rows_epoch", F.col("last_event_ts").alias("known_event_ts")))
        return rows.join(control, "dataset", "left").fillna(
            0, ["epoch", "rows_epoch", "known_event_ts"])

    def _epoch(self, dataset: str) -> int:
        control = self._control().where(F.col("dataset") == F.lit(dataset)).first()
        return control["epoch"] if control else 0

    def _restart(self, dataset: str, offset: int, now: Column, epoch: int, rows_epoch: Column) -> DataFrame:
        """The control row that moves a dataset to ``offset`` in a new epoch."""
        return self.spark.range(1).select(
            F.lit(dataset).alias("dataset"), F.lit(offset).cast("long").alias("last_offset"),
            F.lit(0).cast("long").alias("last_event_ts"), now.alias("updated_at"),
            F.lit(epoch).cast("long").alias("epoch"), rows_epoch.cast("long").alias("rows_epoch"))

    @staticmethod
    def _admin_run(action: str, dataset: str) -> str:
        return f"{action}-{hashlib.sha256(dataset.encode()).hexdigest()[:16]}"
