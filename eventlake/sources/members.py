"""Activity and messaging topics as typed member events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from eventlake.sources.schemas import ACTIVITY_EVENT, MESSAGING_EVENT, record


def _read(messages: DataFrame, schema: T.StructType, value: str, seq: str) -> DataFrame:
    """Typed columns with a ``reason``; a member and a time are needed, unknown keys are ignored."""
    full = T.StructType([*schema.fields, *record(unreadable="string").fields])
    options = {"columnNameOfCorruptRecord": "unreadable"}
    read = messages.select(
        F.col(seq).alias("seq"), F.col(value).alias("raw"),
        F.explode(F.array(F.from_json(value, full, options))).alias("read"))
    reason = F.when(F.col("read").isNull() | F.col("read.unreadable").isNotNull(), "malformed_json") \
        .when(F.col("read.memberId").isNull(), "missing_member") \
        .when(F.col("read.eventTsMs").isNull(), "missing_time")
    return read.select(
        "seq", "raw", F.col("read.memberId").alias("member_id"),
        F.col("read.eventType").alias("event_type"), F.col("read.eventTsMs").alias("ts_ms"),
        *[F.col(f"read.{source}").alias(name) for source, name in OWN_FIELDS.items()
          if source in schema.names],
        reason.alias("reason"))


OWN_FIELDS = {"device": "device", "titleId": "title_id", "channel": "channel",
              "messageType": "message_type", "campaignId": "campaign_id", "messageId": "message_id"}


def activity_events(messages: DataFrame, value: str = "value", seq: str = "offset") -> DataFrame:
    """Activity events of a topic; ``seq`` names the column that numbers arrivals."""
    return _read(messages, ACTIVITY_EVENT, value, seq)


def messaging_events(messages: DataFrame, value: str = "value", seq: str = "offset") -> DataFrame:
    """Messaging events of a topic; ``seq`` names the column that numbers arrivals."""
    return _read(messages, MESSAGING_EVENT, value, seq)


def without_redeliveries(messaging: DataFrame) -> DataFrame:
    """One row per (message, event type), the first to arrive; rows without a message id all stay."""
    rest = [c for c in messaging.columns if c not in ("message_id", "event_type")]
    named = F.col("message_id").isNotNull()
    first = messaging.where(named).groupBy("message_id", "event_type").agg(
        F.min_by(F.struct(*rest), "seq").alias("first")).select("message_id", "event_type", "first.*")
    return first.unionByName(messaging.where(~named))
