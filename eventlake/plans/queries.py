"""The registered queries: each applies one operator to whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventlake.functions.keys import clean_dim, clean_dims, dims_hash, dims_json, dims_map_json
from eventlake.functions.times import zoneless
from eventlake.operators import (
    capture, features, freshness, index, quality, rollups, serving, warehouse)
from eventlake.operators.daystore import KeyLedger
from eventlake.operators.mergetable import MergeTable, fold
from eventlake.plans import fixtures as fx
from eventlake.session import ROW_GROUP, apply_settings, emptied, scratch_dir, streaming_session, written
from eventlake.sources import members, tables
from eventlake.sources.schemas import record
from eventlake.sources.streams import file_stream
from eventlake.sources.validate import (
    check_changes, decodable, parse_envelopes, quarantined, usable, validate_events)
from eventlake.streaming import (
    features as feature_streams, index as index_streams, late as late_streams, progress,
    rollups as rollup_streams, sinks, spikes as spike_streams, warehouse as warehouse_streams)

Query = Callable[[SparkSession, str], DataFrame]

MONEY = "decimal(18,2)"
AS_OF_S = 1_706_659_200  # 2024-01-31 00:00:00 UTC
AS_OF_MS = AS_OF_S * 1000
HOUR, DAY = 3600, 86400
TRIGGER_BYTES = 1 << 30

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(apply_settings(spark), folder)

    QUERIES[build.__name__] = run
    return build


def _flat(df: DataFrame) -> DataFrame:
    """Zone-less timestamps, and maps as JSON text."""
    columns = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "timestamp":
            columns[field.name] = zoneless(F.col(field.name))
        elif kind == "map":
            columns[field.name] = F.to_json(field.name)
        elif kind in ("integer", "short"):
            columns[field.name] = F.col(field.name).cast("long")
    return df.withColumns(columns) if columns else df


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _minute_rollups(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.rollup(fx.metric_events(spark, folder), 60, sum_type=MONEY)


# --- rollups -------------------------------------------------------------------------------------

@query
def rollup_60s(spark, folder):
    return _flat(_minute_rollups(spark, folder))


@query
def rollup_hourly(spark, folder):
    events = fx.metric_events(spark, folder)
    return _flat(rollups.rollup(events, HOUR, ("endpoint", "status"), sum_type=MONEY))


@query
def rollup_daily(spark, folder):
    return _flat(rollups.rollup(fx.metric_events(spark, folder), DAY, (), sum_type=MONEY))


@query
def rollup_deduplicated(spark, folder):
    events = fx.metric_events(spark, folder)
    twice = events.unionByName(events)
    return _flat(rollups.rollup(twice, HOUR, ("endpoint",), sum_type=MONEY, dedupe="event_id"))


@query
def rollup_stored_rows(spark, folder):
    rows = rollups.rollup(fx.metric_events(spark, folder), HOUR, ("endpoint",), sum_type=MONEY)
    return _flat(rollups.stamp(rollups.closed(rows, _moment("2024-01-15 00:00:00"), 60),
                               _moment("2024-01-15 00:00:00")))


@query
def rollup_sketched(spark, folder):
    events = fx.metric_events(spark, folder)
    sketches = rollups.rollup_sketches(events, HOUR, ("endpoint",), sum_type=MONEY)
    merged = rollups.merge_sketches(sketches, DAY, ["metric"])
    exact = rollups.rollup(events, DAY, (), sum_type=MONEY).select("window_start", "metric", "uniques")
    error = F.abs(F.col("uniques_estimate") - F.col("uniques"))
    bound = F.greatest(F.lit(1.0), rollups.SKETCH_ERROR * F.col("uniques"))
    return _flat(merged.join(exact, ["window_start", "metric"]).withColumn(
        "within_bound", error <= bound).drop("uniques_estimate"))


@query
def dims_normalize(spark, folder):
    dims = F.create_map(*[part for c in rollups.DEFAULT_DIMS for part in (F.lit(c), F.col(c))])
    return fx.metric_events(spark, folder).select(
        "event_id", dims_map_json(clean_dims(dims)).alias("dims"))


@query
def dims_hash_rollup(spark, folder):
    """Some endpoints hold a control character, which JSON text escapes."""
    given = fx.metric_events(spark, folder)
    odd = F.when(F.col("event_id").cast("long") % 11 == 0, F.replace("endpoint", F.lit("/v1"), F.lit("/v1\x1f")))
    events = rollups.clean_dim_columns(
        given.withColumn("endpoint", F.coalesce(odd, F.col("endpoint"))), rollups.DEFAULT_DIMS)
    counts = events.groupBy(*rollups.DEFAULT_DIMS).agg(F.count(F.lit(1)).alias("rows"))
    text = dims_json({c: F.col(c) for c in rollups.DEFAULT_DIMS})
    return counts.select(dims_hash(text).alias("dims_hash"), text.alias("dims"), "rows")


@query
def rollup_history(spark, folder):
    return _flat(serving.history(_minute_rollups(spark, folder), "purchase",
                                 _moment("2024-01-05"), _moment("2024-01-20"), 200))


@query
def rollup_latest(spark, folder):
    return _flat(serving.latest(_minute_rollups(spark, folder)))


@query
def rollup_latest_ttl(spark, folder):
    rows = rollups.stamp(_minute_rollups(spark, folder), F.col("window_end"))
    as_of = rows.agg(F.max("updated_at")).scalar()
    return _flat(serving.unexpired(serving.latest(rows), as_of))


@query
def rollup_window_set(spark, folder):
    rows = rollups.rollup(fx.metric_events(spark, folder), DAY, sum_type=MONEY)
    return _flat(serving.window_set(rows, "view", _moment("2024-01-10")))


@query
def rollup_upserted(spark, folder):
    """Every rollup is stored twice, first with half of its value; the later write replaces it."""
    table = rollup_streams.history_table(spark, scratch_dir(spark, "history"))
    rows = rollups.rollup(fx.metric_events(spark, folder), HOUR, ("endpoint",), sum_type=MONEY)
    early = rows.withColumn("count", F.lit(0).cast("long"))
    table.write(rollups.stamp(early, F.col("window_end")), "first", 0)
    table.write(rollups.stamp(rows, F.timestamp_seconds(F.unix_seconds("window_end") + 60)), "first", 1)
    table.compact()
    return _flat(table.read())


@query
def rpm_by_customer(spark, folder):
    return _flat(rollups.count_by(fx.metric_events(spark, folder), ["customer_id"], 60, "requests"))


@query
def error_rate_by_endpoint(spark, folder):
    return _flat(rollups.error_rate(fx.metric_events(spark, folder), HOUR))


@query
def orders_by_status_region(spark, folder):
    read = lambda name: tables.read_table(spark, folder, name)
    joined = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")) \
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy(F.col("r_name").alias("region"), F.col("o_orderstatus").alias("status")) \
        .agg(F.count(F.lit(1)).alias("orders"))


@query
def sliding_uniques_5m(spark, folder):
    return _flat(rollups.sliding_uniques(fx.metric_events(spark, folder)))


@query
def sliding_uniques_any_slide(spark, folder):
    """Windows of 300 s every 90 s: the slide does not divide the window."""
    return _flat(rollups.sliding_uniques(fx.metric_events(spark, folder), 300, 90))


@query
def spend_per_category(spark, folder):
    spent = tables.read_table(spark, folder, "lineitem").join(
        tables.read_table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("p_brand").alias("category"), F.col("l_shipdate").alias("ts"),
            F.col("l_extendedprice").alias("value"))
    return _flat(rollups.count_by(spent, ["category"], 60, "purchases", "spend", MONEY))


@query
def spike_flags(spark, folder):
    hourly = rollups.count_by(fx.metric_events(spark, folder), ["metric"], HOUR, "events")
    flags = rollups.spikes(hourly, ["metric"], "events", HOUR, trailing=24, factor=2.0, slo=10)
    return _flat(flags.withColumn("trailing_mean", F.round("trailing_mean", 6)))


@query
def hot_keys(spark, folder):
    return rollups.key_shares(fx.metric_events(spark, folder), ["endpoint", "metric"], 0.05)


@query
def hot_keys_sketched(spark, folder):
    """Keys of at least a twenty-fifth of all rows, found by a sketch and counted exactly."""
    return rollups.hot_keys(fx.metric_events(spark, folder), ["endpoint", "metric"], 0.04)


@query
def late_audit(spark, folder):
    return _flat(rollups.late_audit(fx.arriving_events(spark, folder), 60).select(
        "event_id", "arrival", "window_start",
        F.timestamp_micros("seen_until_us").alias("seen_until"), "is_late"))


@query
def validate_events_usable(spark, folder):
    return _flat(usable(validate_events(fx.raw_messages(spark, folder))).select(
        "offset", "event_id", "event_type", "metric", "value", "user_id", "customer_id", "endpoint",
        clean_dim(F.col("status")).alias("status"), "ts"))


@query
def quarantine_events(spark, folder):
    return quarantined(validate_events(fx.raw_messages(spark, folder))).select("offset", "reason")


# --- member features -----------------------------------------------------------------------------

def _flat_features(df: DataFrame, channels: tuple[str, ...] = fx.CHANNELS) -> DataFrame:
    sent, reasons = F.col("last_sent_ts_by_channel"), F.col("suppression_reasons")
    return df.withColumns({
        **{f"last_sent_{c}": sent[c] for c in channels},
        **{f"reason_{c}": reasons[c] for c in features.COOLDOWN_MS},
    }).drop("last_sent_ts_by_channel", "suppression_reasons")


@query
def unified_events(spark, folder):
    return fx.member_events(spark, folder)


def _decoded(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return (members.activity_events(fx.member_messages(spark, folder, "ACTIVITY")),
            members.messaging_events(fx.member_messages(spark, folder, "MESSAGE")))


@query
def member_events_decoded(spark, folder):
    activity, messages = _decoded(spark, folder)
    twice = messages.unionByName(messages.withColumn("seq", F.col("seq") + 2 * fx.LATE_OFFSET))
    return features.unify(usable(activity), members.without_redeliveries(usable(twice)))


@query
def member_events_quarantined(spark, folder):
    activity, messages = _decoded(spark, folder)
    return quarantined(activity).select("seq", "reason").unionByName(
        quarantined(messages).select("seq", "reason"))


@query
def activity_buckets(spark, folder):
    return features.activity_buckets(fx.member_events(spark, folder))


@query
def msg_buckets(spark, folder):
    return features.message_buckets(fx.member_events(spark, folder))


@query
def features_per_event(spark, folder):
    return _flat_features(features.feature_changelog(fx.member_events(spark, folder)))


@query
def features_all_channels(spark, folder):
    """Members also get messages on a channel that has no cooldown rule."""
    channels = (*fx.CHANNELS, "sms")
    return _flat_features(features.feature_changelog(fx.member_events(spark, folder, channels)), channels)


@query
def features_timer(spark, folder):
    changes = features.feature_changelog(fx.member_events(spark, folder), timers=True)
    return _flat_features(changes.where(F.col("kind") == "TIMER").drop("kind", "seq"))


@query
def features_asof(spark, folder):
    return _flat_features(features.features_as_of(fx.member_events(spark, folder), AS_OF_MS))


@query
def features_asof_arrival(spark, folder):
    jitter = F.col("seq") * 37 % 41
    arriving = fx.member_events(spark, folder).withColumn(
        "seq", (F.col("seq") + jitter) * 64 + jitter)
    return _flat_features(features.features_as_of(arriving, AS_OF_MS, arrival_order=True))


@query
def features_latest(spark, folder):
    changes = features.feature_changelog(fx.member_events(spark, folder))
    return _flat_features(features.latest_features(changes))


@query
def feature_messages(spark, folder):
    changes = features.feature_changelog(fx.member_events(spark, folder))
    newest = features.latest_features(changes)
    spec = record(**{field: newest.schema[c].dataType for c, field in sinks.FEATURE_FIELDS.items()})
    read = sinks.feature_messages(newest).select("key", F.from_json("value", spec).alias("m"))
    return _flat_features(read.select("key", *[F.col("m")[field].alias(c) for c, field in sinks.FEATURE_FIELDS.items()]))


# --- change capture ------------------------------------------------------------------------------

@query
def capture_versions(spark, folder):
    return fx.change_log(spark, folder).select(
        "offset", "dataset", "record_id", "op", "payload", "version", "event_ts")


@query
def source_state(spark, folder):
    return capture.source_state(fx.change_log(spark, folder))


def _in_three(rows: DataFrame, step: int) -> DataFrame:
    """The ``step``-th third of a log by sequence number."""
    return rows.where(F.floor(F.col("seq") * 3 / (rows.agg(F.max("seq")).scalar() + 1)) == step)


@query
def capture_versions_in_steps(spark, folder):
    """The log in three batches; versions go on from the stored records."""
    mutations, out = fx.record_mutations(spark, folder), scratch_dir(spark, "versions")
    kept = record(dataset="string", record_id="string", op="string", version="long", seq="long")
    store = MergeTable(spark, scratch_dir(spark, "records"), kept, list(capture.RECORD_KEY), ["seq"])
    for step in range(3):
        alive = store.read().where(F.col("op") != "delete")
        events = capture.assign_versions(_in_three(mutations, step), alive)
        events.write.parquet(f"{out}/step={step}")
        events = spark.read.parquet(f"{out}/step={step}")
        store.write(capture.last_changes(events.select(*kept.names)), "run", step)
    return spark.read.parquet(out).select(
        F.col("seq").alias("offset"), "dataset", "record_id", "op", "payload", "version", "event_ts")


@query
def outbox_in_steps(spark, folder):
    """Order changes in three batches; patches go on from the stored orders."""
    mutations, out = fx.order_mutations(spark, folder), scratch_dir(spark, "outbox")
    kept = record(**{n: "long" if n == "amount_kobo" else "string" for n in capture.ORDER_FIELDS}, seq="long")
    store = MergeTable(spark, scratch_dir(spark, "orders"), kept, ["order_id"], ["seq"])
    for step in range(3):
        images = capture.after_images(_in_three(mutations, step), store.read())
        images.write.parquet(f"{out}/step={step}")
        store.write(fold(spark.read.parquet(f"{out}/step={step}").select(*kept.names), ["order_id"], ["seq"]), "run", step)
    return _flat(capture.outbox(spark.read.parquet(out).drop("step")).drop("published_at"))


@query
def outbox_two_runs(spark, folder):
    """A run publishes a batch, the next one fails, a third sends the failed batch again."""
    rows = fx.order_outbox(spark, folder)
    store = MergeTable(spark, scratch_dir(spark, "status"), capture.OUTBOX_STATUS, ["event_id"], ["publish_attempts"])
    for run, errors in enumerate((0, 1, 0)):
        batch = capture.next_to_publish(capture.with_status(rows, store.read()))
        store.write(capture.status_after(batch, _moment(("2024-01-29", "2024-01-30", "2024-01-31")[run]), errors), "run", run)
    return _flat(store.read())


@query
def outbox_created(spark, folder):
    rows = capture.outbox(capture.after_images(fx.order_mutations(spark, folder)))
    return _flat(rows.where(F.col("event_type") == "order.created").drop("published_at"))


@query
def outbox_updated(spark, folder):
    rows = capture.outbox(capture.after_images(fx.order_mutations(spark, folder)))
    return _flat(rows.where(F.col("event_type") == "order.updated").drop("published_at"))


@query
def outbox_next_batch(spark, folder):
    batch = capture.next_to_publish(fx.order_outbox(spark, folder))
    return _flat(batch.select("seq", "aggregate_id", "event_type", "idempotency_key", "created_at"))


@query
def outbox_publish(spark, folder):
    sent = capture.envelopes(fx.order_outbox(spark, folder), keep=("seq",))
    headers = F.array_join(F.transform(
        "headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string"))), ",")
    return sent.select("seq", "key", "value", headers.alias("headers"))


def _mark(spark, folder, errors):
    rows = fx.order_outbox(spark, folder)
    batch = capture.next_to_publish(rows)
    marked = capture.mark_published(rows, batch, _moment("2024-01-31"), errors)
    return _flat(marked.select("seq", "publish_attempts", "published_at"))


@query
def outbox_mark(spark, folder):
    return _mark(spark, folder, errors=0)


@query
def outbox_mark_failed(spark, folder):
    return _mark(spark, folder, errors=1)


@query
def publish_counters(spark, folder):
    return capture.publish_counts(fx.order_outbox(spark, folder))


# --- warehouse -----------------------------------------------------------------------------------

def _order_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    return parse_envelopes(fx.order_messages(spark, folder))


def _usable_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Usable envelopes parsed once, for queries that read them more than once."""
    columns = ("idempotency_key", *warehouse.APPLIED_COLUMNS)
    return written(usable(_order_envelopes(spark, folder)).select(*columns), "envelopes")


def _applied(spark: SparkSession, folder: str, columns: tuple[str, ...] = warehouse.APPLIED_COLUMNS) -> DataFrame:
    return warehouse.first_deliveries(usable(_order_envelopes(spark, folder)), columns)


@query
def wh_dedup(spark, folder):
    """Second half of the topic against a ledger of the first half."""
    envelopes = _usable_envelopes(spark, folder)
    half = F.col("event_type") == "order.created"
    ledger = warehouse.ledger_rows(warehouse.first_deliveries(envelopes.where(half)))
    return warehouse.not_yet_applied(envelopes, ledger).select(
        "idempotency_key", "order_id", "offset")


@query
def wh_dedup_filtered(spark, folder):
    """The same against a ledger filed by days, some of them closed: filters choose the days to open."""
    envelopes = _usable_envelopes(spark, folder)
    half = F.col("event_type") == "order.created"
    known = written(warehouse.ledger_rows(warehouse.first_deliveries(envelopes.where(half))), "known")
    ledger = KeyLedger(spark, scratch_dir(spark, "ledger"), warehouse.LEDGER, "idempotency_key")
    for day in range(4):
        part = F.pmod(F.xxhash64("event_id"), F.lit(4)) == day
        ledger.write(known.where(part), date(2024, 1, 1 + day), "run", day)
    emptied(known)
    ledger.close(date(2024, 1, 3))
    first = written(warehouse.first_deliveries(envelopes), "first-deliveries")
    emptied(envelopes)
    return ledger.unseen(first).select("idempotency_key", "order_id", "offset")


@query
def wh_current(spark, folder):
    return _flat(warehouse.order_rows(_applied(spark, folder)))


@query
def wh_ledger(spark, folder):
    columns = tuple(c for c in warehouse.LEDGER.names if c != "idempotency_key")
    return _flat(warehouse.ledger_rows(_applied(spark, folder, columns)))


@query
def wh_checkpoints(spark, folder):
    return _flat(warehouse.checkpoint_rows(_order_envelopes(spark, folder)))


@query
def wh_recent(spark, folder):
    orders = warehouse.order_rows(_applied(spark, folder))
    return _flat(serving.recent_orders(orders))


@query
def wh_quarantine(spark, folder):
    return _flat(quarantined(_order_envelopes(spark, folder)).select(
        "partition", "offset", "raw", "reason"))


@query
def consume_counters(spark, folder):
    return warehouse.consume_counts(_order_envelopes(spark, folder))


@query
def lake_append(spark, folder):
    rows = warehouse.lake_rows(_order_envelopes(spark, folder), _moment("2024-01-31"))
    return _flat(rows.select("date", "partition", "offset", "event_id", "event_type", "aggregate_id",
                             "idempotency_key", "schema_version", "emitted_at", "payload_json"))


def _stored_warehouse(spark: SparkSession, messages: DataFrame) -> warehouse.Warehouse:
    store = warehouse.Warehouse(spark, scratch_dir(spark, "warehouse"))
    store.apply_batch(parse_envelopes(messages), "run", 0, _moment("2024-01-31"))
    return store


@query
def wh_replay_twice(spark, folder):
    """The topic is stored, delivered again, and its first batch retried: nothing changes."""
    messages = written(fx.order_messages(spark, folder), "order-messages")
    store = _stored_warehouse(spark, messages)
    for _ in range(2):
        store.apply_batch(parse_envelopes(messages), "again", 0, _moment("2024-02-01"))
    return _flat(store.orders.read())


@query
def wh_rebuild(spark, folder):
    store = _stored_warehouse(spark, fx.order_messages(spark, folder))
    lake = tables.read_lake(spark, store.lake_path, date(2024, 1, 31), date(2024, 1, 31))
    return _flat(warehouse.rebuild_orders(lake))


# --- index ---------------------------------------------------------------------------------------

def _now() -> Column:
    return F.lit(AS_OF_S).cast("long")


@query
def index_increment(spark, folder):
    log = fx.change_log(spark, folder)
    return index.next_increment(log, fx.log_checkpoints(log, AS_OF_S)).select(
        "offset", "dataset", "record_id", "op", "payload", "version", "event_ts")


@query
def index_current(spark, folder):
    changes = usable(check_changes(fx.odd_changes(spark, folder)))
    return _flat(index.index_rows(changes, _now()).drop("offset"))


@query
def changes_quarantined(spark, folder):
    return quarantined(check_changes(fx.odd_changes(spark, folder))).select("offset", "reason")


@query
def index_current_by_offset(spark, folder):
    changes = usable(check_changes(fx.change_log(spark, folder)))
    return _flat(index.index_rows(changes, _now(), "offset").drop("offset"))


@query
def index_replay(spark, folder):
    """Everything beyond the checkpoints is applied to an index that already holds it."""
    log = fx.change_log(spark, folder)
    current = index.index_rows(log, _now())
    pending = index.pending_changes(log, fx.log_checkpoints(log, AS_OF_S))
    return _flat(index.apply_changes(current, pending, _now() + 60))


@query
def index_catch_up(spark, folder):
    """An index of the part up to the checkpoints, brought up to date."""
    log = fx.change_log(spark, folder)
    marks = fx.log_checkpoints(log, AS_OF_S)
    done = log.join(marks.select("dataset", "last_offset"), "dataset") \
        .where(F.col("offset") <= F.col("last_offset")).drop("last_offset")
    pending = index.pending_changes(log, marks)
    return _flat(index.apply_changes(index.index_rows(done, _now() - 3600), pending, _now()))


@query
def index_rebuild(spark, folder):
    log = fx.change_log(spark, folder)
    current = index.index_rows(log, _now() - 3600)
    return _flat(index.rebuild(current, capture.source_state(log), "click", _now()))


@query
def index_checkpoint(spark, folder):
    log = fx.change_log(spark, folder)
    marks = fx.log_checkpoints(log, AS_OF_S - 60)
    return index.advance_checkpoints(marks, index.next_increment(log, marks), _now())


@query
def index_checkpoint_replay(spark, folder):
    marks = fx.log_checkpoints(fx.change_log(spark, folder), AS_OF_S - 60)
    return index.set_checkpoint(marks, "click", 100, _now())


@query
def index_recent(spark, folder):
    log = fx.change_log(spark, folder)
    rows = index.index_rows(log, F.col("event_ts"))
    newest = 1_704_931_200  # 2024-01-11 00:00:00 UTC
    return _flat(index.recent_changes(rows, newest, 3600).drop("offset"))


@query
def index_store_replayed(spark, folder):
    """The stored index after a run, a rebuild of one dataset and a replay of its whole log."""
    log = fx.change_log(spark, folder)
    store = index.IndexStore(spark, scratch_dir(spark, "index"))
    store.apply_batch(log, AS_OF_S, "run", 0)
    store.rebuild(capture.source_state(log), "click", AS_OF_S)
    store.apply_batch(index.pending_changes(log, store.checkpoints()), AS_OF_S, "run", 1)
    return _flat(store.index())


# --- freshness and quality -----------------------------------------------------------------------

def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    log = fx.change_log(spark, folder)
    return freshness.dataset_metrics(log, fx.log_checkpoints(log, AS_OF_S - 60), AS_OF_S)


@query
def freshness_metrics(spark, folder):
    return _flat(_metrics(spark, folder))


@query
def freshness_health(spark, folder):
    return freshness.health(_metrics(spark, folder))


@query
def freshness_report(spark, folder):
    """The health answer with the rows of its datasets, written out."""
    report = freshness.health_report(_metrics(spark, folder))
    row = F.explode("rows").alias("r")
    return report.select("ok", "datasets", "stale_datasets", row).select(
        "ok", "datasets", "stale_datasets", "r.dataset", F.col("r.ok").alias("dataset_ok"),
        "r.freshness_lag_seconds", "r.backlog_offsets", "r.max_offset", "r.checkpoint_last_offset")


@query
def run_counters(spark, folder):
    log = fx.change_log(spark, folder)
    done = index.progress(index.next_increment(log, fx.log_checkpoints(log, AS_OF_S)))
    return freshness.run_counters(log, done)


@query
def schema_drift(spark, folder):
    known = ("order_id", "customer_id", "amount_kobo", "currency", "status")
    envelopes = decodable(_order_envelopes(spark, folder))
    return quality.payload_keys(envelopes, "payload", known, "offset")


@query
def reconcile(spark, folder):
    """Orders as created against the warehouse rows that later patches changed."""
    columns = ["customer_id", "amount_kobo", "currency", "status"]
    created = capture.created_orders(_created_source(spark, folder))
    return quality.reconcile(created, warehouse.order_rows(_applied(spark, folder)),
                             ["order_id"], columns)


@query
def reconcile_tree(spark, folder):
    """The same by digest trees: only rows under unequal digests meet."""
    columns = ["customer_id", "amount_kobo", "currency", "status"]
    return quality.reconcile_tree(
        capture.created_orders(_created_source(spark, folder)).select("order_id", *columns),
        written(warehouse.order_rows(_applied(spark, folder)).select("order_id", *columns), "orders"),
        ["order_id"], columns)


def _created_source(spark: SparkSession, folder: str) -> DataFrame:
    orders = tables.read_table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("o-"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("c-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("amount_kobo"),
        F.col("o_orderdate").alias("created_at"))


# --- streams -------------------------------------------------------------------------------------

STREAM_PARTS = 4


def _as_stream(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """Rows written to ``folder`` and read back as a stream of ``STREAM_PARTS`` micro-batches, each with a
    file for every core."""
    cores = spark.sparkContext.defaultParallelism
    rows.repartition(STREAM_PARTS * cores).write.parquet(folder)
    return file_stream(spark, folder, rows.schema, max_files_per_trigger=cores)


def _span(events: DataFrame, ts: Column) -> int:
    """Seconds from the first to the last event: lateness that lets files come in any order."""
    first, last = events.agg(F.min(ts), F.max(ts)).first()
    return int(last - first) + 1 if first is not None else 1


def _lateness(events: DataFrame, window_seconds: int) -> int:
    return _span(events, F.unix_seconds("ts")) // window_seconds + 1


def _closing_event(events: DataFrame, after_s: int) -> DataFrame:
    """One event long after the rest, whose arrival closes every earlier window."""
    blank = {c: F.lit(None).cast(events.schema[c].dataType) for c in events.columns}
    end = events.agg(F.timestamp_seconds(F.unix_seconds(F.max("ts")) + 2 * after_s).alias("ts"))
    return end.select(*[{**blank, "ts": F.col("ts")}[c].alias(c) for c in events.columns])


def _closed_stream(session: SparkSession, folder: str) -> tuple[DataFrame, dict]:
    """The event stream, a far later event that closes its last window, and the options it needs."""
    events = fx.metric_events(session, folder)
    lateness = _lateness(events, HOUR)
    # The closing event comes with a later file: first all events, then it alone.
    source = scratch_dir(session, "stream-events")
    stream = _as_stream(session, events, source)
    _closing_event(events, (lateness + 2) * HOUR).write.mode("append").parquet(source)
    return stream, {"window_seconds": HOUR, "dims": ("endpoint",), "sum_type": MONEY, "lateness_windows": lateness}


@query
def stream_rollup(spark, folder):
    """Final hourly rollups of the event stream."""
    session = streaming_session(spark)
    stream, options = _closed_stream(session, folder)
    out, log = scratch_dir(session, "stream-rollups"), progress.ProgressLog(session, scratch_dir(session, "progress"))
    final = rollup_streams.closed_rollups(stream, **options)
    log.complete(sinks.to_files(final, out, scratch_dir(session, "stream-checkpoint")))
    return _flat(spark.read.schema(final.schema).parquet(out))


@query
def stream_sliding_uniques(spark, folder):
    """Exact users of every five minutes, sliding by one, on the stream."""
    session = streaming_session(spark)
    stream, options = _closed_stream(session, folder)
    out, log = scratch_dir(session, "stream-sliding"), progress.ProgressLog(session, scratch_dir(session, "progress"))
    delay = options["lateness_windows"] * HOUR // 300 + 1
    found = rollup_streams.sliding_uniques(stream, lateness_windows=delay)
    log.complete(sinks.to_files(found, out, scratch_dir(session, "stream-checkpoint")))
    return _flat(spark.read.schema(found.schema).parquet(out))


@query
def stream_spikes(spark, folder):
    """Spikes and outages of the hourly counts, from a ring of 24 windows per metric."""
    session = streaming_session(spark)
    stream, options = _closed_stream(session, folder)
    events = fx.metric_events(session, folder)
    last = events.agg(F.max(F.floor(F.unix_seconds("ts") / HOUR) * HOUR)).scalar()
    out, log = scratch_dir(session, "stream-spikes"), progress.ProgressLog(session, scratch_dir(session, "progress"))
    found = spike_streams.spike_stream(stream, ["metric"], HOUR, f"{options['lateness_windows'] * HOUR} seconds")
    log.complete(sinks.to_files(found, out, scratch_dir(session, "stream-checkpoint")))
    rows = spark.read.schema(found.schema).parquet(out).where((F.unix_seconds("window_start") <= last) & F.col("metric").isNotNull())
    return _flat(rows.select(
        "window_start", "metric", F.col("value").alias("events"), F.round("trailing_mean", 6).alias("trailing_mean"),
        "trailing_points", "is_spike", "is_drop", (F.col("value") > 10).alias("violates_slo")))


@query
def stream_late_rows(spark, folder):
    """Rows in time and late ones of a stream that comes in three runs, in order of arrival."""
    session = streaming_session(spark)
    rows = fx.arriving_events(session, folder)
    source, checkpoint = scratch_dir(session, "stream-arrivals"), scratch_dir(session, "stream-checkpoint")
    split, last = late_streams.LateSplit(session, scratch_dir(session, "stream-late"), 60), rows.agg(F.max("arrival")).scalar()
    for part in range(3):
        rows.where(F.floor(F.col("arrival") * 3 / (last + 1)) == part).write.mode("append").parquet(source)
        stream = file_stream(session, source, rows.schema, max_bytes_per_trigger=TRIGGER_BYTES)
        split.follow(stream, checkpoint).awaitTermination()
    return _flat(split.rows().select(
        "event_id", "arrival", "window_start", F.timestamp_micros("seen_until_us").alias("seen_until"), "is_late"))


@query
def stream_error_rate(spark, folder):
    """Share of rejected records by reason, as the running query reports it."""
    session = streaming_session(spark)
    messages = fx.raw_messages(session, folder)
    source = scratch_dir(session, "stream-text")
    messages.repartition(STREAM_PARTS).write.parquet(source)
    checked = validate_events(file_stream(session, source, messages.schema, max_files_per_trigger=1))
    good = usable(progress.counted(checked, ["malformed_json", "missing_metric"]))
    log = progress.ProgressLog(session, scratch_dir(session, "progress"))
    reports = log.complete(sinks.to_files(good, scratch_dir(session, "stream-good"), scratch_dir(session, "stream-checkpoint")))
    return progress.error_rates(reports).drop("query")


@query
def stream_history(spark, folder):
    """Raw JSON text, checked and rolled up as a stream, written to the history table."""
    session = streaming_session(spark)
    messages = fx.raw_messages(session, folder)
    events = usable(validate_events(messages))
    lateness = _lateness(events, HOUR)
    end = _closing_event(events, (lateness + 2) * HOUR).select(
        F.lit(-1).cast("long").alias("offset"), F.to_json(F.struct(
            F.lit("end").alias("event_id"), F.lit("end").alias("event_type"), F.lit("end").alias("metric"),
            F.unix_millis("ts").alias("ts"))).alias("value"))
    source = scratch_dir(session, "stream-text")
    messages.repartition(STREAM_PARTS).write.parquet(source)
    end.write.mode("append").parquet(source)
    stream = usable(validate_events(file_stream(session, source, messages.schema, max_files_per_trigger=1)))
    table = rollup_streams.history_table(session, scratch_dir(session, "stream-history"))
    log = progress.ProgressLog(session, scratch_dir(session, "progress"))
    log.complete(rollup_streams.follow_history(
        stream, table, "run", scratch_dir(session, "stream-checkpoint"), F.col("window_end"), every=None, compact_every=2,
        window_seconds=HOUR, dims=("endpoint",), sum_type=MONEY, lateness_windows=lateness))
    return _flat(table.read())


@query
def stream_rollup_early(spark, folder):
    """Rollups readable while their windows are open; two runs over the two halves add up."""
    session = streaming_session(spark)
    events = fx.metric_events(session, folder)
    store = rollup_streams.RollupStore(session, scratch_dir(session, "stream-cells"), ("endpoint",),
                                       sum_type=MONEY)
    lateness = _lateness(events, HOUR)
    for half in (0, 1):
        part = events.where(F.col("event_id").cast("long") % 2 == half)
        log = progress.ProgressLog(session, scratch_dir(session, "progress"))
        log.complete(store.follow(
            _as_stream(session, part, scratch_dir(session, "stream-events")), f"run-{half}",
            scratch_dir(session, "stream-checkpoint"), compact_every=2, window_seconds=HOUR, lateness_windows=lateness))
    return _flat(store.read())


def _member_stream(spark: SparkSession, folder: str, rows: DataFrame, unify) -> DataFrame:
    """Feature snapshots of member rows that arrive in time order, in three runs of one stream.

    ``unify`` turns the stream of ``rows`` into member events. Every run goes on from the checkpoint.
    """
    session = rows.sparkSession
    source, out, checkpoint = (scratch_dir(session, p) for p in ("stream-members", "stream-features", "stream-checkpoint"))
    last = rows.agg(F.max("seq")).scalar()
    snapshots = None
    for part in range(3):
        arrived = F.floor(F.col("seq") * 3 / (last + 1)) == part
        rows.where(arrived).write.mode("append").parquet(source)
        stream = unify(file_stream(session, source, rows.schema, max_bytes_per_trigger=TRIGGER_BYTES))
        snapshots = feature_streams.feature_stream(stream)
        log = progress.ProgressLog(session, scratch_dir(session, "progress"))
        log.complete(sinks.to_files(snapshots, out, checkpoint))
    return spark.read.schema(snapshots.schema).parquet(out)


@query
def stream_features(spark, folder):
    session = streaming_session(spark)
    rows = _member_stream(spark, folder, fx.member_events(session, folder), lambda stream: stream)
    return _flat_features(rows.where(F.col("kind") != "TIMER"))


@query
def stream_features_timer(spark, folder):
    """The timer rows of the member stream, one for each boundary its last watermark has passed, by value."""
    session = streaming_session(spark)
    rows = _member_stream(spark, folder, fx.member_events(session, folder), lambda stream: stream)
    return _flat_features(rows.where(F.col("kind") == "TIMER").drop("kind", "seq"))


@query
def stream_features_json(spark, folder):
    """Both topics as JSON text, broken records among them: decode, unify, features."""
    session = streaming_session(spark)
    topics = fx.member_messages(session, folder, "ACTIVITY").withColumn("topic", F.lit("activity")).unionByName(
        fx.member_messages(session, folder, "MESSAGE").withColumn("topic", F.lit("messages")))
    rows = topics.withColumn("seq", F.col("offset") % fx.LATE_OFFSET)

    def unify(stream: DataFrame) -> DataFrame:
        of = lambda topic: stream.where(F.col("topic") == topic).select("offset", "value")
        return features.unify(usable(members.activity_events(of("activity"))), usable(members.messaging_events(of("messages"))))

    found = _member_stream(spark, folder, rows, unify)
    return _flat_features(found.where(F.col("kind") != "TIMER"))


def _streamed_warehouse(spark: SparkSession, folder: str) -> warehouse.Warehouse:
    """The topic arrives in three parts, in offset order, with second deliveries in later parts; every
    part is a run of the same stream, going on from its checkpoint."""
    session = streaming_session(spark)
    messages = written(fx.order_messages(session, folder), "order-messages")
    last = messages.where(F.col("offset") < fx.LATE_OFFSET).agg(F.max("offset")).scalar()
    source, checkpoint = scratch_dir(session, "stream-orders"), scratch_dir(session, "stream-checkpoint")
    store = warehouse.Warehouse(session, scratch_dir(session, "stream-warehouse"))
    for part in range(3):
        arrived = F.least(F.lit(2), F.floor(F.col("offset") * 3 / (last + 1))) == part
        messages.where(arrived).write.mode("append").options(**ROW_GROUP).parquet(source)
        if part == 2:  # all of the topic is in the source
            emptied(messages)
        stream = file_stream(session, source, messages.schema, max_bytes_per_trigger=TRIGGER_BYTES)
        log = progress.ProgressLog(session, scratch_dir(session, "progress"))
        log.complete(warehouse_streams.ingest(stream, store, "run", checkpoint, compact_every=2))
    return store


@query
def stream_warehouse(spark, folder):
    return _flat(_streamed_warehouse(spark, folder).orders.read())


@query
def stream_wh_ledger(spark, folder):
    return _flat(_streamed_warehouse(spark, folder).ledger.read())


@query
def stream_wh_checkpoints(spark, folder):
    return _flat(_streamed_warehouse(spark, folder).checkpoints.read())


@query
def stream_index(spark, folder):
    session = streaming_session(spark)
    log = _as_stream(session, fx.change_log(session, folder), scratch_dir(session, "stream-log"))
    store = index.IndexStore(session, scratch_dir(session, "stream-index"))
    index_streams.follow_log(log, store, "run", scratch_dir(session, "stream-checkpoint"),
                             clock=lambda: AS_OF_S).awaitTermination()
    return _flat(store.index())


@query
def stream_progress(spark, folder):
    """Rows a rollup stream reports to have read and to have dropped as late, from the stored reports."""
    session = streaming_session(spark)
    stream, options = _closed_stream(session, folder)
    log = progress.ProgressLog(session, scratch_dir(session, "progress"), every=2)
    reports = log.complete(sinks.to_files(
        rollup_streams.closed_rollups(stream, **options), scratch_dir(session, "stream-rollups"),
        scratch_dir(session, "stream-checkpoint")))
    return reports.agg(F.sum("input_rows").alias("input_rows"),
                       F.sum("dropped_late_rows").alias("dropped_late_rows"))
