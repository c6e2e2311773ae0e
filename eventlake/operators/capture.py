"""Change capture: versions, after-images, idempotency keys and the outbox."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlake.functions.keys import (
    derived_uuid, idempotency_key, idempotency_text, spaced_json)
from eventlake.functions.times import iso_utc
from eventlake.operators.heavy import (
    HEAVY_ROWS, before_chunk, forward_fill, in_chunks, split_heavy)
from eventlake.sources.schemas import record

RECORD_KEY = ("dataset", "record_id")
PUBLISH_BATCH = 200

# Defaults of an order nobody created explicitly.
DEFAULT_CUSTOMER = "unknown"
DEFAULT_AMOUNT = 0
DEFAULT_CURRENCY = "NGN"
DEFAULT_STATUS = "CREATED"
ORDER_FIELDS = ("order_id", "customer_id", "amount_kobo", "currency", "status")
OUTBOX_STATUS = record(event_id="string", publish_attempts="long", published_at="timestamp")


def assign_versions(mutations: DataFrame, existing: DataFrame | None = None,
                    heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Turn a mutation log (dataset, record_id, op, payload, seq, …) into versioned change events.

    Each mutation gets the previous version plus one; the count starts again at 1 after a delete,
    and a delete carries no payload. A version is the distance to the last delete before it.
    ``existing`` are the records (dataset, record_id, version) that are alive before the log begins;
    without it the log is taken to be the first.
    """
    keys = list(RECORD_KEY)
    if existing is None:
        mutations = mutations.withColumn("known", F.lit(0).cast("long"))
    else:
        known = existing.select(*keys, F.col("version").cast("long").alias("known"))
        mutations = mutations.join(known, keys, "left").fillna(0, ["known"])
    deleted = F.col("op") == "delete"

    def place(rows: DataFrame, partition: list[str]) -> DataFrame:
        ordered = Window.partitionBy(*partition).orderBy("seq")
        return rows.withColumn("place", F.row_number().over(ordered).cast("long")).withColumn(
            "last_delete", F.max(F.when(deleted, F.col("place"))).over(
                ordered.rowsBetween(Window.unboundedPreceding, -1)))

    def version(rows: DataFrame) -> DataFrame:
        return rows.withColumn(
            "version", F.col("place") + F.coalesce(-F.col("last_delete"), F.col("known"))
        ).drop("place", "last_delete", "known")

    def chunked(rows: DataFrame) -> DataFrame:
        placed = place(in_chunks(rows, [*keys, "seq"], heavy_rows=heavy_rows), [*keys, "chunk"])
        totals = placed.groupBy(*keys, "chunk").agg(
            F.max("place").alias("rows"), F.max(F.when(deleted, F.col("place"))).alias("final_delete"))
        earlier = before_chunk(keys, ["chunk"])
        carry = totals.select(*keys, "chunk", "final_delete", F.coalesce(
            F.sum("rows").over(earlier), F.lit(0)).alias("rows_before")) \
            .select(*keys, "chunk", "rows_before", F.max(
                F.col("rows_before") + F.col("final_delete")).over(earlier).alias("delete_before"))
        return version(placed.join(carry, [*keys, "chunk"]).withColumns({
            "place": F.col("place") + F.col("rows_before"),
            "last_delete": F.coalesce(
                F.col("last_delete") + F.col("rows_before"), F.col("delete_before")),
        }).drop("chunk", "rows_before", "delete_before"))

    events = split_heavy(mutations, keys, lambda rows: version(place(rows, keys)), chunked, heavy_rows)
    return events.withColumn("payload", F.when(~deleted, F.col("payload")))


def last_changes(events: DataFrame) -> DataFrame:
    """The last event of every record, deletes included: what a store keeps between batches."""
    kept = [c for c in events.columns if c not in RECORD_KEY]
    return events.groupBy(*RECORD_KEY).agg(
        F.max_by(F.struct(*kept), "seq").alias("last")).select(*RECORD_KEY, "last.*")


def source_state(events: DataFrame) -> DataFrame:
    """Source-of-truth rows after a versioned mutation log; deleted records are absent."""
    last = events.groupBy(*RECORD_KEY).agg(F.max_by(
        F.struct("op", "payload", "version", F.col("event_ts").alias("updated_at")), "seq"
    ).alias("last"))
    return last.select(*RECORD_KEY, "last.*").where(F.col("op") != "delete").drop("op")


def created_orders(orders: DataFrame) -> DataFrame:
    """``order.created`` mutations: status CREATED, currency NGN unless given."""
    currency = F.col("currency") if "currency" in orders.columns else F.lit(None).cast("string")
    return orders.select(
        "seq", F.lit("order.created").alias("event_type"), "order_id", "customer_id",
        F.col("amount_kobo").cast("long").alias("amount_kobo"),
        F.coalesce(currency, F.lit(DEFAULT_CURRENCY)).alias("currency"),
        F.lit(DEFAULT_STATUS).alias("status"), "created_at")


def patched_orders(patches: DataFrame) -> DataFrame:
    """``order.updated`` mutations: null means "not in the patch", unknown columns are ignored."""
    def given(name: str, kind: str) -> Column:
        return (F.col(name) if name in patches.columns else F.lit(None)).cast(kind).alias(name)

    return patches.select(
        "seq", F.lit("order.updated").alias("event_type"), "order_id",
        given("customer_id", "string"), given("amount_kobo", "long"), given("currency", "string"),
        given("status", "string"), "created_at")


def after_images(mutations: DataFrame, existing: DataFrame | None = None,
                 heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Whole orders after each mutation: every field is its last given value, else the default.

    ``existing`` are the orders (``ORDER_FIELDS``) as they were before the first mutation.
    """
    filled = forward_fill(mutations, ["order_id"], "seq", ORDER_FIELDS[1:], heavy_rows)
    defaults = dict(zip(ORDER_FIELDS[1:], (
        DEFAULT_CUSTOMER, DEFAULT_AMOUNT, DEFAULT_CURRENCY, DEFAULT_STATUS)))
    if existing is not None:
        known = existing.select("order_id", *[F.col(c).alias(f"known_{c}") for c in ORDER_FIELDS[1:]])
        filled = filled.join(known, "order_id", "left").withColumns(
            {c: F.coalesce(c, f"known_{c}") for c in ORDER_FIELDS[1:]}).drop(
            *[f"known_{c}" for c in ORDER_FIELDS[1:]])
    return filled.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def outbox(images: DataFrame) -> DataFrame:
    """Outbox rows of order mutations, not yet published.

    The payload of an update also carries its time; equal events get equal idempotency keys.
    """
    fields = {name: F.col(name) for name in ORDER_FIELDS}
    payload = spaced_json({**fields, "updated_at": iso_utc(F.col("created_at"))},
                          only_if={"updated_at": F.col("event_type") == "order.updated"})
    # One step per text, so that each is built once per row.
    worded = images.withColumn("payload", payload).withColumn(
        "key_text", idempotency_text(F.col("event_type"), F.col("order_id"), F.col("payload")))
    return worded.select(
        derived_uuid(F.col("event_type"), F.col("order_id"), F.col("seq")).alias("event_id"),
        F.lit("order").alias("aggregate_type"), F.col("order_id").alias("aggregate_id"),
        "event_type", "payload", idempotency_key(F.col("key_text")).alias("idempotency_key"),
        F.lit(None).cast("timestamp").alias("published_at"),
        F.lit(0).cast("long").alias("publish_attempts"), "created_at", "seq")


def next_to_publish(outbox_rows: DataFrame, batch_size: int = PUBLISH_BATCH) -> DataFrame:
    """The oldest unpublished rows."""
    return outbox_rows.where(F.col("published_at").isNull()) \
        .orderBy("created_at", "seq").limit(batch_size)


def envelopes(outbox_rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Messages for a broker sink: key, JSON value and headers, plus the columns to ``keep``."""
    def header(name: str) -> Column:
        return F.struct(F.lit(name).alias("key"), F.col(name).cast("binary").alias("value"))

    return outbox_rows.select(
        *keep, F.col("aggregate_id").alias("key"),
        spaced_json({
            **{n: F.col(n) for n in (
                "event_id", "event_type", "aggregate_type", "aggregate_id", "idempotency_key",
                "payload")},
            "emitted_at": iso_utc(F.col("created_at")), "schema_version": F.lit(1),
        }, raw=("payload",)).alias("value"),
        F.array(*[header(n) for n in (
            "event_type", "aggregate_type", "aggregate_id", "idempotency_key")]).alias("headers"))


def mark_published(outbox_rows: DataFrame, batch: DataFrame, as_of: Column,
                   errors: int = 0) -> DataFrame:
    """The outbox after one publish run.

    Every row of the batch counts one more attempt; they become published only if no delivery
    failed, otherwise the whole batch is sent again later.
    """
    tried = batch.select("event_id", F.lit(True).alias("tried"))
    marked = outbox_rows.join(tried, "event_id", "left").withColumn(
        "publish_attempts", F.col("publish_attempts") + F.coalesce(F.col("tried").cast("int"), F.lit(0)))
    if errors == 0:
        marked = marked.withColumn(
            "published_at", F.when(F.col("tried"), as_of).otherwise(F.col("published_at")))
    return marked.drop("tried")


def with_status(outbox_rows: DataFrame, status: DataFrame) -> DataFrame:
    """Outbox rows with what earlier publish runs stored of them (``OUTBOX_STATUS``)."""
    known = status.select("event_id", F.col("publish_attempts").alias("tried"),
                          F.col("published_at").alias("sent_at"))
    return outbox_rows.join(known, "event_id", "left").withColumns({
        "publish_attempts": F.coalesce("tried", "publish_attempts"),
        "published_at": F.coalesce("sent_at", "published_at")}).drop("tried", "sent_at")


def status_after(batch: DataFrame, as_of: Column, errors: int = 0) -> DataFrame:
    """What one publish run changes: a row for each row of its batch, and for no other.

    Every row counts one more attempt; they become published only if no delivery failed.
    """
    published = F.col("published_at") if errors else as_of
    return batch.select("event_id", (F.col("publish_attempts") + 1).alias("publish_attempts"),
                        published.cast("timestamp").alias("published_at"))


def publish_counts(batch: DataFrame, errors: int = 0) -> DataFrame:
    """Run counters of one publish run."""
    return batch.agg(F.count(F.lit(1)).alias("published")).withColumn("errors", F.lit(errors).cast("long"))
