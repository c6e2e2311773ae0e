"""Starting stream writers: triggers, checkpoints, per-batch handlers, broker messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

FLUSH_INTERVAL = "2 seconds"
FEATURE_INTERVAL = "30 seconds"
COMPACT_EVERY = 500  # micro-batches between two compactions of a merged table

# Field names of the feature message.
FEATURE_FIELDS = {
    "member_id": "memberId", "snapshot_ts_ms": "snapshotTsMs",
    "last_activity_ts_ms": "lastActivityTsMs",
    "plays_1h": "plays_1h", "plays_24h": "plays_24h",
    "browses_1h": "browses_1h", "browses_24h": "browses_24h",
    "searches_1h": "searches_1h", "searches_24h": "searches_24h",
    "last_sent_ts_by_channel": "lastSentTsByChannel", "messages_sent_24h": "messagesSent_24h",
    "opens_7d": "opens_7d", "clicks_7d": "clicks_7d",
    "eligible_push": "eligiblePush", "eligible_email": "eligibleEmail",
    "suppression_reasons": "suppressionReasons",
}


def writer(stream: DataFrame, checkpoint: str, output_mode: str,
           every: str | None = None) -> DataStreamWriter:
    """A writer that runs every ``every``, or once over all available data.

    Progress is kept under ``checkpoint`` and moves on only after a batch is stored.
    """
    started = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    return started.trigger(processingTime=every) if every else started.trigger(availableNow=True)


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
               output_mode: str = "append", every: str | None = None,
               compact: Callable[[], None] | None = None,
               compact_every: int | None = COMPACT_EVERY) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` on every micro-batch; it must tolerate a repeated batch.

    Before every ``compact_every``-th batch the target is compacted, when no write is under way.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        if compact and compact_every and batch_id and batch_id % compact_every == 0:
            compact()
        handle(batch, batch_id)

    return writer(stream, checkpoint, output_mode, every).foreachBatch(run).start()


def to_files(stream: DataFrame, path: str, checkpoint: str,
             every: str | None = None) -> StreamingQuery:
    """Append rows to Parquet files, exactly once."""
    return writer(stream, checkpoint, "append", every).format("parquet").start(path)


def feature_messages(features: DataFrame) -> DataFrame:
    """Feature snapshots as broker messages keyed by member."""
    named = F.struct(*[F.col(column).alias(field) for column, field in FEATURE_FIELDS.items()])
    return features.select(F.col("member_id").alias("key"), F.to_json(named).alias("value"))


def to_kafka(messages: DataFrame, bootstrap: str, topic: str, checkpoint: str,
             every: str | None = FEATURE_INTERVAL) -> StreamingQuery:
    """Send (key, value[, headers]) rows to a topic, at least once."""
    return writer(messages, checkpoint, "append", every).format("kafka") \
        .option("kafka.bootstrap.servers", bootstrap).option("topic", topic) \
        .option("includeHeaders", str("headers" in messages.columns).lower()).start()
