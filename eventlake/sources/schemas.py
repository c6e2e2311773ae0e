"""Record schemas of the streams and tables."""

from __future__ import annotations

from pyspark.sql import types as T


def record(**fields: str | T.DataType) -> T.StructType:
    """A schema from field names and types; simple types go by their name."""
    schema = T.StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return schema


ACTIVITY_EVENT = record(
    memberId="string", eventType="string", eventTsMs="long", device="string", titleId="string")
MESSAGING_EVENT = record(
    memberId="string", channel="string", messageType="string", campaignId="string",
    messageId="string", eventType="string", eventTsMs="long")
METRIC_EVENT = record(
    event_id="string", event_type="string", metric="string", value="double", user_id="string",
    customer_id="string", endpoint="string", status="string", ts="timestamp", extra="string")
CHANGE_EVENT = record(
    offset="long", dataset="string", record_id="string", op="string", payload="string",
    version="long", event_ts="long")
CHECKPOINT = record(
    dataset="string", last_offset="long", last_event_ts="long", updated_at="long")
INDEX_RECORD = record(
    dataset="string", record_id="string", payload="string", version="long", indexed_at="long",
    tombstone="integer")
LAKE = record(
    ingested_at="timestamp", event_id="string", event_type="string", aggregate_id="string",
    idempotency_key="string", schema_version="integer", payload_json="string", emitted_at="string",
    topic="string", partition="integer", offset="long", applied_at="timestamp", date="date",
    run="string", batch_id="long")
