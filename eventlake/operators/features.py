"""Per-member messaging features over trailing windows.

Events are ordered by (event time, sequence number). The trailing windows are bucketed: a count over
"1 hour" at time t takes every minute bucket from the one holding t - 1h up to t itself, so it spans
61 minute buckets; messaging counts use hour buckets the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlake.functions.times import (
    DAY_MS, HOUR_MS, MINUTE_MS, bucket_floor, bucket_number, next_boundary)
from eventlake.operators.heavy import HEAVY_ROWS, before_chunk, forward_fill, in_chunks, split_heavy

TIMER_MS = 5 * MINUTE_MS
CHANNEL_COLUMNS = 100  # up to so many channels have a column each; with more, rows per channel are filled

# Event names that are counted, the feature they feed, and the rule per channel.
ACTIVITY_COUNTERS = {"play": "plays", "browse": "browses", "search": "searches"}
MESSAGE_COUNTERS = {"sent": "sent", "open": "opens", "click": "clicks"}
COOLDOWN_MS = {"push": 6 * HOUR_MS, "email": DAY_MS}
SUPPRESSED = "cooldown_active"

COUNTERS = (*ACTIVITY_COUNTERS.values(), *MESSAGE_COUNTERS.values())

# feature -> (counter, bucket column, bucket size, whole buckets that lie before the current one)
TRAILING = {
    "plays_1h": ("plays", "minute", MINUTE_MS, 60),
    "browses_1h": ("browses", "minute", MINUTE_MS, 60),
    "searches_1h": ("searches", "minute", MINUTE_MS, 60),
    "plays_24h": ("plays", "minute", MINUTE_MS, 1440),
    "browses_24h": ("browses", "minute", MINUTE_MS, 1440),
    "searches_24h": ("searches", "minute", MINUTE_MS, 1440),
    "messages_sent_24h": ("sent", "hour", HOUR_MS, 24),
    "opens_7d": ("opens", "hour", HOUR_MS, 168),
    "clicks_7d": ("clicks", "hour", HOUR_MS, 168),
}


def unify(activity: DataFrame, messages: DataFrame) -> DataFrame:
    """Both event streams as one, tagged by ``kind``. Message types are lower-cased, null is ''."""
    return activity.select(
        F.lit("ACTIVITY").alias("kind"), "member_id", "event_type",
        F.lit(None).cast("string").alias("channel"), "ts_ms", "seq",
    ).unionByName(messages.select(
        F.lit("MESSAGE").alias("kind"), "member_id",
        F.lower(F.coalesce("event_type", F.lit(""))).alias("event_type"),
        "channel", "ts_ms", "seq"))


def activity_buckets(events: DataFrame) -> DataFrame:
    """Activity count per member, minute and event type."""
    return events.where(F.col("kind") == "ACTIVITY").groupBy(
        "member_id", bucket_floor(F.col("ts_ms"), MINUTE_MS).alias("bucket_ms"), "event_type"
    ).agg(F.count(F.lit(1)).alias("count"))


def message_buckets(events: DataFrame) -> DataFrame:
    """Sent, open and click counts per member and hour; other types still open a bucket."""
    return events.where(F.col("kind") == "MESSAGE").groupBy(
        "member_id", bucket_floor(F.col("ts_ms"), HOUR_MS).alias("bucket_ms")
    ).agg(*[F.count_if(F.col("event_type") == t).alias(t) for t in MESSAGE_COUNTERS])


def _flags() -> dict[str, Column]:
    """One boolean per counter: does this event feed it?"""
    flags = {c: (F.col("kind") == "ACTIVITY") & (F.col("event_type") == t)
             for t, c in ACTIVITY_COUNTERS.items()}
    flags.update({c: (F.col("kind") == "MESSAGE") & (F.col("event_type") == t)
                  for t, c in MESSAGE_COUNTERS.items()})
    return flags


def _is_sent() -> Column:
    return _flags()["sent"] & F.col("channel").isNotNull()


def with_eligibility(snapshots: DataFrame) -> DataFrame:
    """Cooldown rules: eligible when the last send lies at least the cooldown back, or never was."""
    def eligible(channel: str, cooldown: int) -> Column:
        last = F.coalesce(F.col("last_sent_ts_by_channel")[channel], F.lit(0))
        return F.col("snapshot_ts_ms") - last >= F.lit(cooldown)

    ruled = snapshots.withColumns({f"eligible_{c}": eligible(c, ms) for c, ms in COOLDOWN_MS.items()})
    reasons = [part for c in COOLDOWN_MS for part in
               (F.lit(c), F.when(~F.col(f"eligible_{c}"), F.lit(SUPPRESSED)))]
    return ruled.withColumn("suppression_reasons", F.map_filter(
        F.create_map(*reasons), lambda _, reason: reason.isNotNull()))


FEATURE_COLUMNS = (
    "member_id", "snapshot_ts_ms", "last_activity_ts_ms", *TRAILING, "last_sent_ts_by_channel",
    "eligible_push", "eligible_email", "suppression_reasons")


def features_as_of(events: DataFrame, as_of_ms: int, arrival_order: bool = False) -> DataFrame:
    """One snapshot per member from the events up to ``as_of_ms``.

    Two aggregations, (member, channel) then member, both combined before the shuffle. With
    ``arrival_order`` the last send is the one that arrived last (``seq``), which may go back in
    time; otherwise the latest one.
    """
    flags = _flags()
    now = F.lit(as_of_ms)
    cutoffs = {name: bucket_floor(F.lit(as_of_ms - size * back), size)
               for name, (_, _, size, back) in TRAILING.items()}
    # Bucket start >= cutoff is the same as event time >= cutoff, because cutoffs are bucket starts.
    counts = [F.count_if(flags[counter] & (F.col("ts_ms") >= cutoffs[name])).alias(name)
              for name, (counter, _, _, _) in TRAILING.items()]
    sent_ts = F.when(_is_sent(), F.col("ts_ms"))
    last_sent = F.max_by(F.col("ts_ms"), F.when(_is_sent(), F.col("seq"))) if arrival_order \
        else F.max(sent_ts)
    per_channel = events.where(F.col("ts_ms") <= now).groupBy("member_id", "channel").agg(
        *counts,
        F.max(F.when(F.col("kind") == "ACTIVITY", F.col("ts_ms"))).alias("last_activity_ts_ms"),
        last_sent.alias("last_sent"))
    entry = F.when(F.col("last_sent").isNotNull(), F.struct("channel", "last_sent"))
    snapshots = per_channel.groupBy("member_id").agg(
        now.alias("snapshot_ts_ms"),
        F.coalesce(F.max("last_activity_ts_ms"), F.lit(0)).alias("last_activity_ts_ms"),
        *[F.sum(name).alias(name) for name in TRAILING],
        F.map_from_entries(F.collect_list(entry)).alias("last_sent_ts_by_channel"))
    return with_eligibility(snapshots).select(*FEATURE_COLUMNS)


def timer_marks(events: DataFrame) -> DataFrame:
    """One mark per member and 5-minute boundary that follows an event."""
    return events.select("member_id", next_boundary(F.col("ts_ms"), TIMER_MS).alias("ts_ms")) \
        .distinct().select(F.lit("TIMER").alias("kind"), "member_id",
                           F.lit(None).cast("string").alias("event_type"),
                           F.lit(None).cast("string").alias("channel"), "ts_ms",
                           F.lit(2 ** 63 - 1).alias("seq"))


def sent_channels(events: DataFrame, most: int = CHANNEL_COLUMNS) -> list[str] | None:
    """The channels messages were sent on; None where there are more than ``most``."""
    found = events.where(_is_sent()).select("channel").distinct().limit(most + 1).collect()
    return sorted(r["channel"] for r in found) if len(found) <= most else None


SNAPSHOT_KEY = ("member_id", "kind", "ts_ms", "seq")


def _sent_maps(rows: DataFrame, heavy_rows: int) -> DataFrame:
    """The last-sent map of every row, from one row per channel its member ever sent on.

    As many rows as the maps have entries in the end; no task holds more than a stretch of a member.
    """
    of_member = rows.where(_is_sent()).select("member_id", "channel").distinct().withColumnRenamed("channel", "sent_on")
    own = F.coalesce(_is_sent() & (F.col("channel") == F.col("sent_on")), F.lit(False))
    spread = rows.join(of_member, "member_id").select(
        *SNAPSHOT_KEY, "sent_on", F.struct("ts_ms", "seq").alias("at"), F.when(own, F.col("ts_ms")).alias("sent_ms"))
    filled = forward_fill(spread, ["member_id", "sent_on"], "at", ["sent_ms"], heavy_rows)
    entries = F.collect_list(F.struct("sent_on", "sent_ms"))
    return filled.where(F.col("sent_ms").isNotNull()).groupBy(*SNAPSHOT_KEY).agg(
        F.map_from_entries(entries).alias("last_sent_ts_by_channel"))


def feature_changelog(events: DataFrame, channels: Sequence[str] | None = None,
                      timers: bool = False, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """A snapshot per event, with ``timers`` also per 5-minute boundary after an event.

    ``channels`` are the channels that get an entry in the last-sent map; without them they are
    taken from the events, however many there are. A send on a channel that is not listed stops the job.
    ``kind`` and ``seq`` tell what caused a row; timer rows sort after the events of their own millisecond.
    """
    channels = sent_channels(events) if channels is None else list(channels)
    rows = events.select("kind", "member_id", "event_type", "channel", "ts_ms", "seq")
    if timers:
        rows = rows.unionByName(timer_marks(events))
    if channels is None:
        maps = _sent_maps(rows, heavy_rows)
        plain = _changelog(rows, [], heavy_rows, events, F.col("kind")).drop("last_sent_ts_by_channel")
        joined = plain.withColumn("ts_ms", F.col("snapshot_ts_ms")).join(maps, list(SNAPSHOT_KEY), "left").withColumn(
            "last_sent_ts_by_channel", F.coalesce("last_sent_ts_by_channel", F.create_map().cast("map<string,bigint>")))
        return with_eligibility(joined).select("kind", "seq", *FEATURE_COLUMNS)
    unlisted = F.coalesce(_is_sent(), F.lit(False)) & ~F.col("channel").isin(*channels)
    kind = F.when(unlisted, F.raise_error(F.concat(F.lit("unlisted channel "), F.col("channel")))).otherwise(F.col("kind"))
    shaped = _changelog(rows, channels, heavy_rows, events, kind)
    return with_eligibility(shaped).select("kind", "seq", *FEATURE_COLUMNS)


def _changelog(rows: DataFrame, channels: Sequence[str], heavy_rows: int, counted: DataFrame, kind: Column) -> DataFrame:
    """Counts, last activity and the last sends of the listed channels of every row."""
    flags = _flags()
    prepared = rows.select(
        kind.alias("kind"), "member_id", "ts_ms", "seq",
        bucket_number(F.col("ts_ms"), MINUTE_MS).alias("minute"),
        bucket_number(F.col("ts_ms"), HOUR_MS).alias("hour"),
        *[F.coalesce(flags[c], F.lit(False)).cast("int").alias(c) for c in COUNTERS],
        F.when(F.col("kind") == "ACTIVITY", F.col("ts_ms")).alias("activity_ms"),
        *[F.when(_is_sent() & (F.col("channel") == c), F.col("ts_ms")).alias(_sent_column(i))
          for i, c in enumerate(channels)])
    latest = ["activity_ms", *[_sent_column(i) for i in range(len(channels))]]
    snapshots = split_heavy(
        prepared, ["member_id"],
        lambda part: _whole_member(part, latest),
        lambda part: _member_in_chunks(part, latest, heavy_rows), heavy_rows, counted=counted)
    sent = [part for i, c in enumerate(channels) for part in (F.lit(c), F.col(_sent_column(i)))]
    return snapshots.withColumns({
        "snapshot_ts_ms": F.col("ts_ms"),
        "last_activity_ts_ms": F.coalesce("activity_ms", F.lit(0)),
        "last_sent_ts_by_channel": F.map_filter(
            F.create_map(*sent).cast("map<string,bigint>"), lambda _, ts: ts.isNotNull()),
    })


def _sent_column(i: int) -> str:
    return f"sent_ms_{i}"


def _expired(partition: Sequence[str], bucket: str, back: int):
    """Rows whose bucket has left a trailing window reaching ``back`` buckets behind this row's."""
    return Window.partitionBy(*partition).orderBy(bucket).rangeBetween(
        Window.unboundedPreceding, -(back + 1))


def _trailing(so_far: Column, counter: str, bucket: str, back: int) -> Column:
    expired = F.sum(counter).over(_expired(["member_id"], bucket, back))
    return F.coalesce(so_far, F.lit(0)) - F.coalesce(expired, F.lit(0))


def _whole_member(rows: DataFrame, latest: Sequence[str]) -> DataFrame:
    """All rows of a member in one window partition: one shuffle, no join."""
    so_far = Window.partitionBy("member_id").orderBy("ts_ms", "seq").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return rows.select(
        "kind", "member_id", "ts_ms", "seq",
        *[_trailing(F.sum(counter).over(so_far), counter, bucket, back).alias(name)
          for name, (counter, bucket, _, back) in TRAILING.items()],
        *[F.max(c).over(so_far).alias(c) for c in latest])


def _member_in_chunks(rows: DataFrame, latest: Sequence[str], heavy_rows: int) -> DataFrame:
    """Members with very many rows: one chunk per minute, and several for a minute with many rows.

    Chunk totals of a member are bounded by the calendar plus the number of ranges its rows take.
    """
    chunk = ["slice", "block"]
    rows = in_chunks(rows, ["member_id", "ts_ms", "seq"], "block", heavy_rows).withColumn(
        "slice", F.col("minute") * MINUTE_MS)
    totals = rows.groupBy("member_id", "minute", "hour", *chunk).agg(
        *[F.sum(c).alias(c) for c in COUNTERS], *[F.max(c).alias(c) for c in latest])
    earlier = before_chunk(["member_id"], chunk)
    carry = totals.select(
        "member_id", *chunk,
        *[_trailing(F.sum(counter).over(earlier), counter, bucket, back).alias(f"carry_{name}")
          for name, (counter, bucket, _, back) in TRAILING.items()],
        *[F.max(c).over(earlier).alias(f"carry_{c}") for c in latest])
    inside = Window.partitionBy("member_id", *chunk).orderBy("ts_ms", "seq").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    own = rows.select(
        "kind", "member_id", "ts_ms", "seq", *chunk,
        *[F.sum(counter).over(inside).alias(name) for name, (counter, _, _, _) in TRAILING.items()],
        *[F.max(c).over(inside).alias(c) for c in latest])
    return own.join(carry, ["member_id", *chunk]).select(
        "kind", "member_id", "ts_ms", "seq",
        *[(F.col(name) + F.col(f"carry_{name}")).alias(name) for name in TRAILING],
        *[F.greatest(c, f"carry_{c}").alias(c) for c in latest])


def latest_features(changelog: DataFrame) -> DataFrame:
    """The newest snapshot of every member of a changelog."""
    values = [c for c in FEATURE_COLUMNS if c != "member_id"]
    return changelog.groupBy("member_id").agg(
        F.max_by(F.struct(*values), F.struct("snapshot_ts_ms", "seq")).alias("newest")
    ).select("member_id", "newest.*")
