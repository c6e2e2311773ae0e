"""Input streams and tables derived from the given Parquet tables.

Every derivation covers its whole table. Duplicates, disorder, blanks and broken records, which the
tables lack, are worked into every row's copy by arithmetic on its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventlake.functions.times import iso_utc
from eventlake.operators.capture import (
    after_images, assign_versions, created_orders, envelopes, outbox, patched_orders)
from eventlake.operators.features import unify
from eventlake.sources.tables import read_table

ENDPOINTS = ("/v1/find", "/v1/basket", "/v1/help", "/v1/enter", "/v1/account")
STATUSES = ("201", "204", "302", "409", "422", "503", " \t ")
CHANNELS = ("push", "email", "interstitial")
ORDER_STATUS = {"F": "DELIVERED", "P": "SHIPPED", "O": "PAID"}
TOPIC = "shop-order-changes"
TOPIC_PARTITIONS = 6
LATE_OFFSET = 1_000_000_000_000


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[(number % len(values)).cast("int")]


def metric_events(spark: SparkSession, folder: str) -> DataFrame:
    """Raw metric events with missing and empty users and blank statuses."""
    events = read_table(spark, folder, "events")
    number = F.col("event_id")
    user = F.when(number % 13 == 0, F.lit(None)).when(number % 17 == 0, "") \
        .otherwise(F.concat(F.lit("u-"), F.col("user_id").cast("string")))
    key = F.regexp_extract("props", "[0-9]+", 0).cast("long")
    return events.select(
        number.cast("string").alias("event_id"), "event_type", F.col("event_type").alias("metric"),
        "value", user.alias("user_id"),
        F.concat(F.lit("cust_"), (key % 10).cast("string")).alias("customer_id"),
        _pick(ENDPOINTS, number).alias("endpoint"), _pick(STATUSES, number).alias("status"), "ts")


def arriving_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a unique ``arrival`` number that runs up to 40 positions out of time order."""
    jitter = F.col("event_id") * 37 % 41
    return read_table(spark, folder, "events").select(
        "event_id", "ts", ((F.col("event_id") + jitter) * 64 + jitter).alias("arrival"))


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Metric events as JSON text; some cut short or followed by more text, some without a metric, with
    a null or no value."""
    events = metric_events(spark, folder)
    number = F.col("event_id").cast("long")
    metric = F.when(number % 19 != 0, F.col("metric"))
    fields = [F.col("event_id"), F.col("event_type"), metric.alias("metric"), F.col("user_id"),
              F.col("customer_id"), F.col("endpoint"), F.col("status"),
              iso_utc(F.col("ts")).alias("ts")]
    with_value = F.to_json(F.struct(F.col("value"), *fields))
    no_value = F.to_json(F.struct(*fields))
    null_value = F.concat(F.lit('{"value":null,'), F.substring(no_value, F.lit(2), F.length(no_value)))
    text = F.when(number % 23 == 0, null_value).when(number % 29 == 0, no_value).otherwise(with_value)
    value = F.when(number % 17 == 0, F.left(text, F.lit(40))) \
        .when(number % 31 == 0, F.concat(text, F.lit('{"x":1}'))).otherwise(text)
    return events.select(number.alias("offset"), value.alias("value"))


def member_events(spark: SparkSession, folder: str, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """Activity and messaging events of members, as one unified stream."""
    events = read_table(spark, folder, "events").select(
        F.concat(F.lit("m"), F.expr("user_id div 3").cast("string")).alias("member_id"),
        "event_type", F.unix_millis("ts").alias("ts_ms"), F.col("event_id").alias("seq"))
    source = F.col("event_type")
    activity = events.withColumn("event_type", F.when(source == "view", "play")
                                 .when(source == "click", "browse").when(source == "signup", "search"))
    reaction = _pick(("open", "click", "delivered"), F.col("seq"))
    messages = events.withColumn("event_type", F.when(source == "purchase", "Sent")
                                 .when(source == "error", reaction)) \
        .withColumn("channel", _pick(channels, F.expr("seq div 3")))
    named = F.col("event_type").isNotNull()
    return unify(activity.where(named), messages.where(named))


def member_messages(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Member events of one kind as JSON text, each followed by a copy that was cut short."""
    rows = member_events(spark, folder).where(F.col("kind") == kind)
    own = {"ACTIVITY": [F.lit("tv").alias("device")],
           "MESSAGE": ["channel", F.concat(F.lit("msg-"), F.col("seq").cast("string")).alias("messageId")]}
    text = F.to_json(F.struct(
        F.col("member_id").alias("memberId"), F.col("event_type").alias("eventType"),
        F.col("ts_ms").alias("eventTsMs"), *own[kind]))
    copies = F.array(F.struct(F.col("seq").alias("offset"), text.alias("value")),
                     F.struct((F.col("seq") + LATE_OFFSET).alias("offset"), F.left(text, F.lit(20)).alias("value")))
    return rows.select(F.explode(copies).alias("m")).select("m.*")


def order_mutations(spark: SparkSession, folder: str) -> DataFrame:
    """Creates, status patches and amount patches of orders, and patches of unknown orders."""
    orders = read_table(spark, folder, "orders")
    number = F.col("o_orderkey") * 4
    order_id = F.concat(F.lit("o-"), F.col("o_orderkey").cast("string")).alias("order_id")
    amount = F.round(F.col("o_totalprice") * 100).cast("long")
    placed = F.col("o_orderdate")
    created = created_orders(orders.select(
        number.alias("seq"), order_id,
        F.concat(F.lit("c-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        amount.alias("amount_kobo"), placed.alias("created_at")))
    status = F.create_map(*[F.lit(x) for pair in ORDER_STATUS.items() for x in pair])
    no_amount, no_status = F.lit(None).cast("long"), F.lit(None).cast("string")
    moved = F.struct(F.lit(1).alias("step"), status[F.col("o_orderstatus")].alias("status"),
                     no_amount.alias("amount_kobo"))
    surcharged = F.struct(F.lit(2).alias("step"), no_status.alias("status"),
                          (amount + 5000).alias("amount_kobo"))
    patch = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(moved, surcharged)) \
        .otherwise(F.array(moved))
    patched = patched_orders(orders.select(
        "*", F.explode(patch).alias("patch")).select(
            (number + F.col("patch.step")).alias("seq"), order_id, "patch.status", "patch.amount_kobo",
            F.timestamp_seconds(F.unix_seconds(placed) + F.col("patch.step") * 86400).alias("created_at")))
    unknown = patched_orders(read_table(spark, folder, "customer").select(
        (F.col("c_custkey") * 4 + 3).alias("seq"),
        F.concat(F.lit("x-"), F.col("c_custkey").cast("string")).alias("order_id"),
        F.round(F.col("c_acctbal") * 100).cast("long").alias("amount_kobo"),
        F.lit("1998-01-01 00:00:00").cast("timestamp").alias("created_at")))
    return created.unionByName(patched).unionByName(unknown)


def order_outbox(spark: SparkSession, folder: str) -> DataFrame:
    return outbox(after_images(order_mutations(spark, folder)))


def order_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Order envelopes as topic messages.

    Every envelope is delivered twice, the second time 21 offsets and an hour later. Low-priority
    orders also left a message that was cut short, and every customer one without a key.
    """
    sent = envelopes(order_outbox(spark, folder), keep=("seq", "created_at"))
    delivery = F.explode(F.array(F.lit(0), F.lit(1))).alias("delivery")
    delivered = sent.select("seq", "value", "created_at", delivery).select(
        "seq", (F.col("seq") * 2 + F.col("delivery") * 21).alias("offset"), "value",
        F.timestamp_seconds(F.unix_seconds("created_at") + F.col("delivery") * 3600).alias("applied_at"))
    orders = read_table(spark, folder, "orders").where(F.col("o_orderpriority") == "5-LOW")
    late = F.lit("1999-01-01 00:00:00").cast("timestamp").alias("applied_at")
    cut = orders.select(
        (F.col("o_orderkey") * 4).alias("seq"), (F.col("o_orderkey") * 8 + LATE_OFFSET).alias("offset"),
        F.concat(F.lit('{"event_id": "'), F.col("o_orderkey").cast("string")).alias("value"), late)
    pings = read_table(spark, folder, "customer").select(
        (F.col("c_custkey") * 4).alias("seq"), (F.col("c_custkey") * 8 + LATE_OFFSET + 1).alias("offset"),
        F.concat(F.lit('{"ping": '), F.col("c_custkey").cast("string"), F.lit("}")).alias("value"), late)
    partition = (F.expr("seq div 4") % TOPIC_PARTITIONS).cast("int")
    return delivered.unionByName(cut).unionByName(pings).select(
        F.lit(TOPIC).alias("topic"), partition.alias("partition"), "offset", "value", "applied_at")


def record_mutations(spark: SparkSession, folder: str) -> DataFrame:
    """A mutation log over records: each event writes its user's record, every tenth deletes it, and
    some write it without a payload."""
    op = F.when(F.col("event_id") % 10 == 3, "delete").otherwise("upsert")
    return read_table(spark, folder, "events").select(
        F.col("event_type").alias("dataset"),
        F.concat(F.lit("R-"), F.col("user_id").cast("string")).alias("record_id"),
        op.alias("op"), F.when((op == "upsert") & (F.col("event_id") % 7 != 0), F.col("props")).alias("payload"),
        (F.col("event_id") + 1).alias("seq"), F.unix_seconds("ts").alias("event_ts"))


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    """The versioned change events of ``record_mutations``; offsets are its sequence numbers."""
    return assign_versions(record_mutations(spark, folder)).withColumn("offset", F.col("seq"))


def odd_changes(spark: SparkSession, folder: str) -> DataFrame:
    """``change_log`` and copies of its rows that no consumer knows what to do with."""
    log = change_log(spark, folder)
    strange = log.where(F.col("offset") % 41 == 0).withColumns(
        {"op": F.lit("touch"), "version": F.col("version") + 1000})
    return log.unionByName(strange).unionByName(
        log.where(F.col("offset") % 43 == 0).withColumn("version", F.lit(None).cast("long")))


def log_checkpoints(log: DataFrame, updated_at_s: int) -> DataFrame:
    """Progress through half of the log; ``view`` is at its end and ``signup`` was never read."""
    half = log.agg(F.expr("max(offset) div 2")).scalar()
    reached = (F.col("dataset") == "view") | (F.col("offset") <= half)
    return log.where((F.col("dataset") != "signup") & reached).groupBy("dataset").agg(
        F.max("offset").alias("last_offset"), F.max("event_ts").alias("last_event_ts"),
        F.lit(updated_at_s).cast("long").alias("updated_at"))
