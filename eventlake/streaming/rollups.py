"""Rollups of an endless event stream.

Exact unique users never sit in one state value: state is kept per (group, user), so a dominant
group is spread over the cluster by its users.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from eventlake.operators.mergetable import MergeTable
from eventlake.operators.rollups import (
    DEFAULT_DIMS, DEFAULT_WINDOW_SECONDS, LATENESS_WINDOWS, ROLLUP_KEY, clean_dim_columns,
    exact_sum, person, with_dims_key)
from eventlake.sources.schemas import record
from eventlake.streaming.sinks import COMPACT_EVERY, FLUSH_INTERVAL, each_batch

ROLLUP_COLUMNS = ("window_start", "window_end", "metric", "dims_hash", "dims", "count", "sum",
                  "uniques")


def user_cells(events: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS,
               dims: Sequence[str] = DEFAULT_DIMS, sum_type: str | None = None,
               lateness_windows: int = LATENESS_WINDOWS, dedupe: str | None = None) -> DataFrame:
    """Count and sum per (window, metric, dimensions, user).

    Events are accepted until ``lateness_windows`` windows after their window's end; later ones are
    dropped and counted in the query progress. ``dedupe`` names an id column for repeated deliveries.
    """
    delay = f"{lateness_windows * window_seconds} seconds"
    events = clean_dim_columns(events, dims).withWatermark("ts", delay)
    if dedupe:
        events = events.dropDuplicatesWithinWatermark([dedupe])
    return events.withColumn("user_id", person(F.col("user_id"))).groupBy(
        F.window("ts", f"{window_seconds} seconds"), "metric", *dims, "user_id"
    ).agg(F.count(F.lit(1)).alias("count"), exact_sum(F.col("value"), sum_type).alias("sum"))


def _finish(totals: DataFrame, dims: Sequence[str]) -> DataFrame:
    return with_dims_key(totals, dims).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *ROLLUP_COLUMNS[2:])


def _per_group(cells: DataFrame, window, dims: Sequence[str], sum_type: str | None) -> DataFrame:
    return cells.groupBy(window, "metric", *dims).agg(
        F.sum("count").alias("count"), exact_sum(F.col("sum"), sum_type).alias("sum"),
        F.count("user_id").alias("uniques"))


def closed_rollups(events: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS,
                   dims: Sequence[str] = DEFAULT_DIMS, sum_type: str | None = None,
                   lateness_windows: int = LATENESS_WINDOWS,
                   dedupe: str | None = None) -> DataFrame:
    """Final rollups, each emitted once when its window can no longer change (append mode)."""
    cells = user_cells(events, window_seconds, dims, sum_type, lateness_windows, dedupe)
    window = F.window(F.window_time("window"), f"{window_seconds} seconds").alias("window")
    return _finish(_per_group(cells, window, dims, sum_type), dims)


def _slides(window_seconds: int, slide_seconds: int) -> str:
    if window_seconds % slide_seconds:
        raise ValueError("on a stream the slide divides the window")
    return f"{slide_seconds} seconds"


def _ending(totals: DataFrame, window_seconds: int) -> DataFrame:
    """Sliding windows by their last slide, as rows with start and end."""
    end = F.col("window.end")
    return totals.where("uniques > 0").select(
        F.timestamp_seconds(F.unix_seconds(end) - window_seconds).alias("window_start"), end.alias("window_end"), "uniques")


def sliding_uniques(events: DataFrame, window_seconds: int = 300, slide_seconds: int = 60,
                    lateness_windows: int = LATENESS_WINDOWS) -> DataFrame:
    """Exact distinct users of every sliding window that has any, once it can no longer change.

    Users are reduced to one row per slide, and only those are copied to the windows of that slide.
    State is per (slide, user) and (window, user), so no window is ever one value.
    """
    slide, whole = _slides(window_seconds, slide_seconds), f"{window_seconds} seconds"
    timed = events.withWatermark("ts", f"{lateness_windows * window_seconds} seconds")
    seen = timed.groupBy(F.window("ts", slide), person(F.col("user_id")).alias("user_id")).agg(F.count(F.lit(1)).alias("n"))
    held = seen.groupBy(F.window(F.window_time("window"), whole, slide).alias("window"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return _ending(held.groupBy(F.window(F.window_time("window"), slide).alias("window")).agg(
        F.count("user_id").alias("uniques")), window_seconds)


def sliding_sketches(events: DataFrame, window_seconds: int = 300, slide_seconds: int = 60,
                     lateness_windows: int = LATENESS_WINDOWS, precision: int = 12) -> DataFrame:
    """The same estimated: one user sketch per slide, merged over the slides of a window.

    State does not depend on the number of users. The error is ``SKETCH_ERROR`` at the default precision.
    """
    slide, whole = _slides(window_seconds, slide_seconds), f"{window_seconds} seconds"
    timed = events.withWatermark("ts", f"{lateness_windows * window_seconds} seconds")
    seen = timed.groupBy(F.window("ts", slide)).agg(F.hll_sketch_agg(person(F.col("user_id")), precision).alias("users"))
    merged = seen.groupBy(F.window(F.window_time("window"), whole, slide).alias("window")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("uniques"))
    # the windows of one slide differ in their end alone, so that end names them
    return merged.where("uniques > 0").select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "uniques")


class RollupStore:
    """Rollups that are readable early and corrected while late events come in.

    Each micro-batch stores the user cells it changed. Inside a run (a checkpoint) a cell only ever
    grows, so its largest count is its newest state, whatever order batches are read in. Runs follow
    one another over different events, so their cells are added up. Reading the same events again is
    a replay: it starts over without the earlier cells.
    """

    def __init__(self, spark: SparkSession, root: str, dims: Sequence[str] = DEFAULT_DIMS,
                 sum_type: str | None = None):
        self.dims, self.sum_type = list(dims), sum_type
        schema = record(
            window=record(start="timestamp", end="timestamp"), metric="string",
            **{name: "string" for name in [*self.dims, "user_id", "source"]}, count="long", sum="double")
        self.cell_key, self.schema, self.root = ["window", "metric", *self.dims, "user_id"], schema, root
        self.runs = MergeTable(spark, f"{root}/runs", record(source="string", checkpoint="string", replays="long"),
                               ["source"], ["replays", "checkpoint"])

    @property
    def cells(self) -> MergeTable:
        """The cells since the last replay."""
        replays = self.runs.read().agg(F.max("replays")).first()[0] or 0
        return self._cells(replays)

    def _cells(self, replays: int) -> MergeTable:
        return MergeTable(self.runs.spark, f"{self.root}/cells-{replays}", self.schema, [*self.cell_key, "source"], ["count"])

    def follow(self, events: DataFrame, run: str, checkpoint: str, every: str | None = None,
               compact_every: int | None = COMPACT_EVERY, replay: bool = False, **options) -> StreamingQuery:
        """Keep the store up to date with a stream; ``options`` are those of ``user_cells``.

        A run goes on from its own checkpoint. The name of a run with another checkpoint is refused,
        because it would be unclear whether its events were counted before.
        """
        known = self.runs.read().where(F.col("source") == F.lit(run)).first()
        replays = (self.runs.read().agg(F.max("replays")).first()[0] or 0) + replay
        if not replay and known and known["checkpoint"] != checkpoint:
            raise ValueError(f"run {run!r} has another checkpoint; name a new run or ask for a replay")
        self.runs.write(self.runs.spark.createDataFrame([(run, checkpoint, replays)], self.runs.schema), run, 0)
        stored = self._cells(replays)
        cells = user_cells(events, dims=self.dims, sum_type=self.sum_type, **options)
        return each_batch(
            cells, lambda batch, batch_id: stored.write(batch.withColumn("source", F.lit(run)), run, batch_id),
            checkpoint, "update", every, stored.compact, compact_every)

    def read(self) -> DataFrame:
        cells = self.cells.read().groupBy(*self.cell_key).agg(
            F.sum("count").alias("count"), exact_sum(F.col("sum"), self.sum_type).alias("sum"))
        return _finish(_per_group(cells, "window", self.dims, self.sum_type), self.dims)


HISTORY = record(
    window_start="timestamp", window_end="timestamp", metric="string", dims_hash="string",
    dims=T.MapType(T.StringType(), T.StringType()), count="long", sum="double", uniques="long",
    updated_at="timestamp")


def follow_history(events: DataFrame, table: MergeTable, run: str, checkpoint: str,
                   updated_at=None, every: str | None = FLUSH_INTERVAL,
                   compact_every: int | None = COMPACT_EVERY, **options) -> StreamingQuery:
    """Write every finished rollup of a stream into ``history_table`` at the flush cadence.

    ``every=None`` stops after what is there. ``updated_at`` is the time of the flush unless given.
    """
    stamp = F.current_timestamp() if updated_at is None else updated_at
    final = closed_rollups(events, **options)
    return each_batch(
        final, lambda batch, batch_id: table.write(batch.withColumn("updated_at", stamp), run, batch_id),
        checkpoint, "append", every, table.compact, compact_every)


def history_table(spark: SparkSession, path: str) -> MergeTable:
    """Durable rollups by natural key: writing a key again replaces its values."""
    return MergeTable(spark, path, HISTORY, list(ROLLUP_KEY), ["updated_at"])
