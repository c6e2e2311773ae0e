"""Spikes and outages of a windowed count, reported while they last."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processor travels to the executors whole, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FLAGS = ("window_start", "value", "trailing_mean", "trailing_points", "is_spike", "is_drop")


class SpikeRing(StatefulProcessor):
    """The last ``trailing`` counts of a key, and a timer at the end of the window that comes next.

    A window whose end the watermark has passed without a row is a zero, so an outage is a drop as soon
    as it is one. A key that stays silent is followed for ``trailing`` windows; should it speak again, the
    windows between are reported then. State is one list per key, whatever the number of events or windows.
    """

    def __init__(self, keys: list[str], window_ms: int, trailing: int, factor: float):
        self.made = Row(*keys, *FLAGS)
        self.window_ms, self.trailing, self.factor = window_ms, trailing, factor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("ring", "next_ms long, counts array<long>")

    def _flag(self, key: Any, start_ms: int, value: int, counts: list[int]) -> Row:
        points = len(counts)
        mean = sum(counts) / points if points else None
        full = points == self.trailing
        flagged = self.made(*key, start_ms, value, mean, points, full and value > mean * self.factor,
                            full and value * self.factor < mean)
        counts.append(value)
        del counts[:-self.trailing]
        return flagged

    def _followed(self, counts: list[int]) -> bool:
        return len(counts) < self.trailing or any(counts)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        known = self.state.exists()
        following, counts = self.state.get() if known else (None, [])
        counts, before = list(counts), following
        for row in sorted(rows, key=lambda r: r["start_ms"]):
            while following is not None and following < row["start_ms"]:
                yield self._flag(key, following, 0, counts)
                following += self.window_ms
            yield self._flag(key, row["start_ms"], row["value"], counts)
            following = row["start_ms"] + self.window_ms
        if before is not None:
            self.handle.deleteTimer(before + self.window_ms)
        self.handle.registerTimer(following + self.window_ms)
        self.state.update((following, counts))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        following, counts = self.state.get()
        counts, watermark = list(counts), timerValues.getCurrentWatermarkInMs()
        while following + self.window_ms <= watermark and self._followed(counts):
            yield self._flag(key, following, 0, counts)
            following += self.window_ms
        if self._followed(counts):
            self.handle.registerTimer(following + self.window_ms)
        self.state.update((following, counts))

    def close(self) -> None:
        pass


def spike_stream(events: DataFrame, keys: Sequence[str], window_seconds: int, delay: str, trailing: int = 24,
                 factor: float = 2.0, value: Column | None = None) -> DataFrame:
    """Flags of every window of every key, from its first one on, once the watermark has passed it.

    Columns: keys, window_start, value (the count unless given as an aggregate), trailing_mean,
    trailing_points, is_spike, is_drop. Events more than ``delay`` late are dropped and counted in the
    query progress.
    """
    counted = events.withWatermark("ts", delay).groupBy(F.window("ts", f"{window_seconds} seconds"), *keys).agg(
        (F.count(F.lit(1)) if value is None else value).cast("long").alias("value"))
    rows = counted.select(*keys, F.window_time("window").alias("at"), F.unix_millis("window.start").alias("start_ms"), "value")
    out = T.StructType([*[events.schema[k] for k in keys], T.StructField("window_start", T.LongType()), *T._parse_datatype_string(
        "value long, trailing_mean double, trailing_points long, is_spike boolean, is_drop boolean").fields])
    flagged = rows.groupBy(*keys).transformWithState(
        SpikeRing(list(keys), window_seconds * 1000, trailing, factor), out, "Append", "EventTime")
    return flagged.withColumn("window_start", F.timestamp_millis("window_start"))
