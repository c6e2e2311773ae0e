"""Per-member feature snapshots from a stream, one per event and one per timer."""

from __future__ import annotations

import bisect
import sys
from collections.abc import Iterator
from operator import itemgetter
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventlake.functions.times import DAY_MS, HOUR_MS, MINUTE_MS
from eventlake.operators.features import (
    ACTIVITY_COUNTERS, FEATURE_COLUMNS, MESSAGE_COUNTERS, TIMER_MS, TRAILING, with_eligibility)
from eventlake.sources.schemas import record

# The processor travels to the executors whole, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WATERMARK_DELAY = "30 seconds"
RETENTION_MS = {"minute": DAY_MS, "hour": 7 * DAY_MS}
BUCKET_MS = {"minute": MINUTE_MS, "hour": HOUR_MS}
LAST_SENT_RETENTION_MS = 90 * DAY_MS
# How long a member's parts outlive the last event that wrote them.
IDLE_MS = {"minute": 26 * HOUR_MS, "hour": 8 * DAY_MS, "sent": LAST_SENT_RETENTION_MS}

OUTPUT = record(
    kind="string", seq="long", member_id="string", snapshot_ts_ms="long", last_activity_ts_ms="long",
    **{name: "long" for name in TRAILING},
    last_sent_ts_by_channel=T.MapType(T.StringType(), T.LongType()))
Snapshot = Row(*OUTPUT.names)

COUNTERS = {"minute": list(ACTIVITY_COUNTERS.values()), "hour": list(MESSAGE_COUNTERS.values())}
PARTS = (*COUNTERS, "sent")
HEAD = T.StructType([T.StructField("last_activity", T.LongType()), T.StructField("last_boundary", T.LongType()),
                     T.StructField("boundaries", T.ArrayType(T.LongType()))])
# What a batch changed of a member's buckets: their starts and their counts since then.
CHANGES = record(starts=T.ArrayType(T.LongType()), counts=T.ArrayType(T.ArrayType(T.LongType())))
CHANNEL, SENT_AT = record(channel="string"), record(at="long")
# A log of changes is written anew when it has so many rows, or twice the buckets that are left and these.
LOG_ROWS, LOG_SLACK = 16, 64
ARRIVAL = ("member_id", "kind", "event_type", "channel", "ts_ms", "seq")
PLACE = {"ACTIVITY": {t: i for i, t in enumerate(ACTIVITY_COUNTERS)},
         "MESSAGE": {t: i for i, t in enumerate(MESSAGE_COUNTERS)}}
# The trailing windows, each looked up once a snapshot, and where every feature is found in them.
FOUND_IN = [((bucket, size, back), COUNTERS[bucket].index(counter)) for counter, bucket, size, back in TRAILING.values()]
WINDOWS = list(dict.fromkeys(window for window, _ in FOUND_IN))


class BucketCounts:
    """Counts per bucket start, with the totals before each bucket at hand.

    A trailing sum is then one binary search, however many buckets the member has. Events usually
    belong to the newest bucket, which leaves those totals as they are.
    """

    def __init__(self, cells: dict[int, list[int]], width: int):
        self.cells, self.width = cells, width
        self.starts, self.before = sorted(cells), []
        self._sum_up()

    def _sum_up(self, first: int = 0) -> None:
        """Total up the buckets from the ``first`` on; those before it have not changed."""
        self.total = [0] * self.width if first == 0 else [
            a + b for a, b in zip(self.before[first - 1], self.cells[self.starts[first - 1]])]
        del self.before[first:]
        for start in self.starts[first:]:
            self.before.append(self.total)
            self.total = [a + b for a, b in zip(self.total, self.cells[start])]

    def add(self, start: int, place: int | None) -> None:
        """Open the bucket if it is new and count one event in it."""
        if start not in self.cells:
            self.cells[start] = [0] * self.width
            if not self.starts or start > self.starts[-1]:
                self.starts.append(start)
                self.before.append(list(self.total))
            else:
                position = bisect.bisect_left(self.starts, start)
                self.starts.insert(position, start)
                self._sum_up(position)
        if place is not None:
            self.cells[start][place] += 1
            if start == self.starts[-1]:
                self.total[place] += 1
            else:
                self._sum_up(bisect.bisect_left(self.starts, start))

    def since(self, oldest: int) -> list[int]:
        """Counts of all buckets that start at ``oldest`` or later."""
        position = bisect.bisect_left(self.starts, oldest)
        if position == len(self.starts):
            return [0] * self.width
        return [a - b for a, b in zip(self.total, self.before[position])]


class Member:
    """What is remembered of one member, in the form it is worked with, and which parts of it changed."""

    def __init__(self, head: tuple | None, logs: dict[str, list[tuple]], sent: dict[str, int]):
        self.last_activity, self.last_boundary, boundaries = head or (0, 0, [])
        self.boundaries, self.sent = list(boundaries), sent
        self.log_rows = {bucket: len(log) for bucket, log in logs.items()}
        self.log_entries = {bucket: sum(len(starts) for starts, _ in log) for bucket, log in logs.items()}
        self.counts = {bucket: BucketCounts(
            {start: list(cell) for starts, cells in logs[bucket] for start, cell in zip(starts, cells)}, len(names))
            for bucket, names in COUNTERS.items()}
        self.changed: dict[str, set] = {part: set() for part in PARTS}

    def part(self, name: str) -> dict:
        """A part as a map: bucket starts to counts, or channels to the last send."""
        return self.sent if name == "sent" else self.counts[name].cells

    def take(self, kind: str, event_type: str | None, channel: str | None, now: int) -> None:
        """Count one event and note the timer boundary that follows it."""
        bucket = "minute" if kind == "ACTIVITY" else "hour"
        if bucket == "minute":
            self.last_activity = max(self.last_activity, now)
        elif event_type == "sent" and channel is not None:
            self.sent[channel] = now
            self.changed["sent"].add(channel)
        start = _floor(now, BUCKET_MS[bucket])
        self.counts[bucket].add(start, PLACE[kind].get(event_type))
        self.changed[bucket].add(start)
        boundary = _floor(now, TIMER_MS) + TIMER_MS
        if boundary > self.last_boundary:
            self.boundaries.append(boundary)
            self.last_boundary = boundary

    def _keep(self, part: str, kept: dict) -> None:
        self.changed[part] |= self.part(part).keys() - kept.keys()
        if part == "sent":
            self.sent = kept
        else:
            self.counts[part] = BucketCounts(kept, self.counts[part].width)

    def forget(self, now: int) -> None:
        """Drop what no snapshot from ``now`` on can see."""
        for bucket, counts in list(self.counts.items()):
            oldest = _floor(now - RETENTION_MS[bucket], BUCKET_MS[bucket])
            if counts.starts and counts.starts[0] < oldest:
                self._keep(bucket, {start: cell for start, cell in counts.cells.items() if start >= oldest})
        self._keep("sent", {c: ts for c, ts in self.sent.items() if ts >= now - LAST_SENT_RETENTION_MS})

    def leaves_at(self) -> int | None:
        """When the next part of an idle member may go; None if there is none."""
        newest = {bucket: counts.starts[-1] if counts.starts else None for bucket, counts in self.counts.items()}
        newest["sent"] = max(self.sent.values(), default=None)
        return min((at + IDLE_MS[part] for part, at in newest.items() if at is not None), default=None)

    def let_go(self, now: int) -> None:
        """Drop the parts of an idle member whose time is over."""
        for bucket, counts in list(self.counts.items()):
            if counts.starts and counts.starts[-1] + IDLE_MS[bucket] <= now:
                self._keep(bucket, {})
        if self.sent and max(self.sent.values()) + IDLE_MS["sent"] <= now:
            self._keep("sent", {})

    def outgrown(self, bucket: str) -> bool:
        """Whether a log is long, or mostly holds buckets that were changed again or dropped since."""
        return self.log_rows[bucket] >= LOG_ROWS or \
            self.log_entries[bucket] > 2 * len(self.part(bucket)) + LOG_SLACK

    def changes(self, bucket: str, whole: bool) -> tuple:
        """All buckets, or those that are new or counted again."""
        cells = self.part(bucket)
        starts = sorted(cells if whole else self.changed[bucket] & cells.keys())
        return starts, [cells[start] for start in starts]

    def snapshot(self, key: Any, kind: str, seq: int | None, now: int) -> Row:
        seen = {w: self.counts[w[0]].since(_floor(now - w[2] * w[1], w[1])) for w in WINDOWS}
        trailing = [seen[window][place] for window, place in FOUND_IN]
        return Snapshot(kind, seq, key[0], now, self.last_activity, *trailing, dict(self.sent))


class MemberFeatures(StatefulProcessor):
    """Keeps the buckets of a member as logs: a batch adds one row with those it changed, and reads a log at once.

    A call to the state store costs more than the work on an event, so there are a few for each member and
    batch, however many buckets they touch. Buckets no snapshot can see any more are left out when a log
    that has outgrown what is left is written anew as one row; a part without any is cleared.

    Rows are taken in arrival order (``seq``), so the last send to arrive wins, while the last
    activity is the latest one. A micro-batch holds as many rows of a member as the source's rate
    cap lets through. Boundaries wait in the state. A boundary's snapshot is made before the first row
    behind it is taken, so it holds the member as of the boundary; if no such row comes, a timer makes it
    once the watermark has passed. After the last boundary the timer stands where a part of the idle
    member may go, and with the last part goes the state.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", HEAD)
        self.logs = {bucket: handle.getListState(bucket, CHANGES) for bucket in COUNTERS}
        self.sent = handle.getMapState("sent", CHANNEL, SENT_AT)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        member = self._load(self.head.get())
        waiting = bool(member.boundaries)
        for _, kind, event_type, channel, now, seq, *_ in sorted(rows, key=itemgetter(ARRIVAL.index("seq"))):
            while member.boundaries and member.boundaries[0] < now:
                yield member.snapshot(key, "TIMER", None, member.boundaries.pop(0))
            member.take(kind, event_type, channel, now)
            yield member.snapshot(key, kind, seq, now)
        if not waiting and member.boundaries:
            self.handle.registerTimer(member.boundaries[0])
        self._store(member)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        head = self.head.get()
        if head is None:
            return
        member = self._load(head)
        watermark = timerValues.getCurrentWatermarkInMs()
        while member.boundaries and member.boundaries[0] <= watermark:
            yield member.snapshot(key, "TIMER", None, member.boundaries.pop(0))
        member.forget(watermark)
        if not member.boundaries:
            member.let_go(watermark)
        at = member.boundaries[0] if member.boundaries else member.leaves_at()
        if at is None:
            for state in (self.head, *self.logs.values(), self.sent):
                state.clear()
        else:
            self.handle.registerTimer(at)
            self._store(member)

    def close(self) -> None:
        pass

    def _load(self, head: tuple | None) -> Member:
        if head is None:
            return Member(None, {bucket: [] for bucket in COUNTERS}, {})
        sent = {channel: at for (channel,), (at,) in self.sent.iterator()}
        return Member(head, {bucket: list(log.get()) for bucket, log in self.logs.items()}, sent)

    def _store(self, member: Member) -> None:
        """Write the head and what changed, and a log anew where that is due."""
        self.head.update((member.last_activity, member.last_boundary, member.boundaries))
        for bucket, log in self.logs.items():
            if not member.part(bucket):
                if member.log_rows[bucket]:
                    log.clear()
            elif member.outgrown(bucket):
                log.put([member.changes(bucket, whole=True)])
            elif member.changed[bucket] & member.part(bucket).keys():
                log.appendValue(member.changes(bucket, whole=False))
        for channel in member.changed["sent"]:
            if channel in member.sent:
                self.sent.updateValue((channel,), (member.sent[channel],))
            elif self.sent.containsKey((channel,)):
                self.sent.removeKey((channel,))


def _floor(ts_ms: int, size: int) -> int:
    return ts_ms // size * size


def feature_stream(events: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Snapshots of a unified event stream (``operators.features.unify``), with eligibility.

    Events older than the watermark are dropped; pass a longer ``delay`` if they must count.
    """
    timed = events.select(*ARRIVAL, F.timestamp_millis("ts_ms").alias("event_ts")).withWatermark("event_ts", delay)
    snapshots = timed.groupBy("member_id").transformWithState(
        MemberFeatures(), OUTPUT, "Append", "EventTime")
    return with_eligibility(snapshots).select("kind", "seq", *FEATURE_COLUMNS)
