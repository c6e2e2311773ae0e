"""Stored tables: retries, replays, compaction, rebuilds, freshness."""

import pytest
from pyspark.sql import functions as F

from eventlake.operators import capture, freshness, index, quality, warehouse
from eventlake.operators.mergetable import MergeTable
from eventlake.session import CHECKPOINT_SETTING, scratch_dir
from eventlake.sources.schemas import record
from eventlake.sources.tables import read_dataset, read_lake
from eventlake.sources.validate import parse_envelopes

MESSAGES = "topic string, partition int, offset long, value string, applied_at timestamp"


def envelope(spark, *rows):
    data = [("t", 0, offset, value, None) for offset, value in rows]
    df = spark.createDataFrame(data, MESSAGES).withColumn("applied_at", F.timestamp_seconds("offset"))
    return parse_envelopes(df)


def order(key, order_id="o-1", amount=100, event="order.created"):
    return (f'{{"event_id":"e-{key}","event_type":"{event}","aggregate_id":"{order_id}",'
            f'"idempotency_key":"{key}","payload":{{"order_id":"{order_id}","customer_id":"c-1",'
            f'"amount_kobo":{amount},"currency":"NGN","status":"CREATED"}}}}')


def test_merge_table_retry_and_compaction(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), record(k="string", v="long", at="long", born="long"),
                       ["k"], ["at"], earliest=["born"])
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v long, at long, born long")
    assert table.read().count() == 0
    table.write(rows(("a", 1, 1, 1), ("b", 1, 1, 1)), "r", 0)
    for _ in range(2):  # a retried batch replaces itself
        table.write(rows(("a", 2, 5, 5)), "r", 1)
    table.write(rows(("a", 9, 3, 3)), "late run", 0)  # an older change stored later
    expected = {("a", 2, 5, 1), ("b", 1, 1, 1)}
    assert {tuple(r) for r in table.read().collect()} == expected
    table.compact()
    assert table.batches().count() == 2
    assert {tuple(r) for r in table.read().collect()} == expected
    first = {f for f in table.batches().inputFiles() if "/closed/" in f}
    table.compact()  # nothing new
    table.write(rows(("b", 7, 9, 9)), "r", 2)
    assert {tuple(r) for r in table.read().collect()} == {("a", 2, 5, 1), ("b", 7, 9, 1)}
    table.compact()  # writes the one row that came since, and leaves the closed segment alone
    closed = {f for f in table.batches().inputFiles() if "/closed/" in f}
    assert first < closed and table.batches().count() == 3
    table.write(rows(("b", 7, 9, 9)), "r", 2)  # a retry of a batch that was compacted
    assert {tuple(r) for r in table.read().collect()} == {("a", 2, 5, 1), ("b", 7, 9, 1)}


def test_same_event_twice_gives_one_order(spark, tmp_path):
    store = warehouse.Warehouse(spark, str(tmp_path))
    store.apply_batch(envelope(spark, (1, order("k1")), (2, order("k1"))), "r", 0)
    rows = store.orders.read().collect()
    assert [(r.order_id, r.amount_kobo, r.last_offset) for r in rows] == [("o-1", 100, 1)]
    assert store.checkpoints.read().first().offset == 2
    assert store.ledger.read().count() == 1


def test_replayed_event_does_not_undo_a_later_one(spark, tmp_path):
    store = warehouse.Warehouse(spark, str(tmp_path))
    store.apply_batch(envelope(spark, (1, order("k1", amount=1)), (2, order("k2", amount=2))), "r", 0)
    for _ in range(2):  # the second time is a retry of the same batch
        store.apply_batch(envelope(spark, (3, order("k1", amount=1)), (4, order("k3", "o-2"))), "r", 1)
    got = {r.order_id: (r.amount_kobo, r.created_at.second, r.updated_at.second)
           for r in store.orders.read().collect()}
    assert got == {"o-1": (2, 1, 2), "o-2": (100, 4, 4)}
    assert store.ledger.read().count() == 3


def test_lake_keeps_duplicates_and_rebuilds_the_orders(spark, tmp_path):
    store = warehouse.Warehouse(spark, str(tmp_path))
    batch = envelope(spark, (1, order("k1", amount=1)), (2, order("k1", amount=1)), (3, "broken"),
                     (4, '{"idempotency_key":"k9","payload":{}}'), (5, order("k2", amount=5)))
    store.apply_batch(batch, "r", 0)
    lake = read_lake(spark, store.lake_path)
    assert sorted(r.offset for r in lake.collect()) == [1, 2, 4, 5]
    assert {r.reason for r in spark.read.parquet(f"{tmp_path}/quarantine").collect()} == {
        "malformed_json", "missing_order_id"}
    rebuilt = warehouse.rebuild_orders(lake).drop("last_event_id").collect()
    assert [tuple(r) for r in rebuilt] == [
        tuple(r) for r in store.orders.read().drop("last_event_id").collect()]
    counts = warehouse.consume_counts(batch).first()
    assert tuple(counts) == (5, 1, 1)


def test_known_keys_are_dropped_without_shuffling_the_ledger(spark):
    envelopes = envelope(spark, (1, order("k1")), (2, order("k2")))
    ledger = spark.createDataFrame([("k1",)], "idempotency_key string")
    fresh = warehouse.not_yet_applied(envelopes, ledger)
    assert [r.idempotency_key for r in fresh.collect()] == ["k2"]


LOG = "`offset` long, dataset string, record_id string, op string, payload string, version long, event_ts long"


def change_log(spark):
    return spark.createDataFrame([
        (1, "tickets", "R-701", "upsert", "first text", 1, 100), (2, "tickets", "R-701", "upsert", "second text", 2, 101),
        (3, "notes", "N-51", "upsert", None, 1, 102), (4, "notes", "N-51", "delete", None, 2, 103)], LOG)


def test_index_ignores_duplicates(spark, tmp_path):
    store = index.IndexStore(spark, str(tmp_path))
    for batch_id in range(2):
        store.apply_batch(index.next_increment(change_log(spark), store.checkpoints()), 200, "r", batch_id)
    store.apply_batch(change_log(spark), 300, "again", 0)
    got = {r.record_id: (r.payload, r.version, r.tombstone, r.indexed_at)
           for r in store.index().collect()}
    assert got["R-701"] == ("second text", 2, 0, 200) or got["R-701"][:3] == ("second text", 2, 0)
    assert got["N-51"][:3] == (None, 2, 1)


def test_increment_is_limited_per_dataset(spark):
    log = change_log(spark)
    none = spark.createDataFrame([], "dataset string, last_offset long")
    got = {(r.dataset, r.offset) for r in index.next_increment(log, none, limit=1).collect()}
    assert got == {("tickets", 1), ("notes", 3)}
    assert index.next_increment(log, none, datasets=["notes"]).count() == 2


def test_rebuild_drops_tombstones_and_replay_is_gated(spark, tmp_path):
    store = index.IndexStore(spark, str(tmp_path))
    log = change_log(spark)
    store.apply_batch(log, 200, "r", 0)
    source = spark.createDataFrame([("notes", "N-52", "x", 3), ("tickets", "R-701", "other", 9)],
                                   "dataset string, record_id string, payload string, version long")
    store.rebuild(read_dataset(source, "notes"), "notes", 300)
    rows = {r.record_id: (r.payload, r.version) for r in store.index().collect()}
    assert rows == {"R-701": ("second text", 2), "N-52": ("x", 3)}
    marks = {r.dataset: (r.last_offset, r.last_event_ts) for r in store.checkpoints().collect()}
    assert marks == {"tickets": (2, 101), "notes": (0, 0)}
    store.apply_batch(index.pending_changes(log, store.checkpoints()), 400, "r", 1)
    rows = {r.record_id: (r.payload, r.version, r.tombstone) for r in store.index().collect()}
    assert rows == {"R-701": ("second text", 2, 0), "N-52": ("x", 3, 0), "N-51": (None, 2, 1)}
    store.replay("tickets", 1, 500)
    marks = {r.dataset: (r.last_offset, r.last_event_ts) for r in store.checkpoints().collect()}
    assert marks == {"tickets": (1, 0), "notes": (4, 103)}
    store.apply_batch(index.pending_changes(log, store.checkpoints()), 600, "r", 2)
    assert {r.dataset: r.last_offset for r in store.checkpoints().collect()} == {"tickets": 2, "notes": 4}
    before = sorted(map(tuple, store.index().collect()))
    store.compact()
    assert sorted(map(tuple, store.index().collect())) == before
    control = store.table.batches().where(F.col("part") == index.CONTROL_PART)
    # per record and epoch one row: the three that count, those of "notes" and "tickets" before rebuild and replay
    assert store.table.batches().where("row IS NOT NULL").count() == 5
    assert control.where("control IS NULL").count() == 0 and control.select("control.dataset").distinct().count() == 2


def test_recreated_record_loses_by_version_and_wins_by_offset(spark):
    log = spark.createDataFrame([
        (1, "d", "r", "upsert", "a", 1, 1), (2, "d", "r", "upsert", "b", 2, 2),
        (3, "d", "r", "delete", None, 3, 3), (4, "d", "r", "upsert", "c", 1, 4)], LOG)
    by_version = index.index_rows(log, F.lit(0).cast("long")).first()
    by_offset = index.index_rows(log, F.lit(0).cast("long"), "offset").first()
    assert (by_version.payload, by_version.tombstone) == (None, 1)
    assert (by_offset.payload, by_offset.tombstone) == ("c", 0)
    with pytest.raises(ValueError):
        index.index_rows(log, F.lit(0), "time")


def test_checkpoints_move(spark):
    marks = spark.createDataFrame([("tickets", 1, 500, 0), ("x", 7, 7, 0)],
                                  "dataset string, last_offset long, last_event_ts long, updated_at long")
    got = {r.dataset: tuple(r)[1:] for r in index.advance_checkpoints(
        marks, change_log(spark), F.lit(9)).collect()}
    assert got == {"tickets": (2, 500, 9), "notes": (4, 103, 9), "x": (7, 7, 0)}
    got = {r.dataset: tuple(r)[1:] for r in index.set_checkpoint(marks, "new", 5, F.lit(9)).collect()}
    assert got == {"tickets": (1, 500, 0), "x": (7, 7, 0), "new": (5, 0, 9)}


def test_lag_falls_after_indexing(spark, tmp_path):
    store = index.IndexStore(spark, str(tmp_path))
    log = change_log(spark)
    before = freshness.dataset_metrics(log, store.checkpoints(), 1000)
    assert {r.dataset: (r.backlog_offsets, r.freshness_lag_seconds, r.ok) for r in before.collect()} == {
        "tickets": (2, 101, True), "notes": (4, 103, True)}
    store.apply_batch(log, 200, "r", 0)
    after = freshness.dataset_metrics(log, store.checkpoints(), 1000)
    assert all(r.backlog_offsets == 0 and r.checkpoint_last_event_ts == r.max_event_ts
               for r in after.collect())
    health = freshness.health(after).first()
    assert (health.ok, health.datasets) == (True, 2)


def test_unread_dataset_is_not_ok(spark):
    log = change_log(spark).withColumn("event_ts", F.lit(1_700_000_000).cast("long"))
    marks = spark.createDataFrame([("notes", 4, 1_699_999_800, 0)],
                                  "dataset string, last_offset long, last_event_ts long, updated_at long")
    got = {r.dataset: (r.freshness_lag_seconds, r.ok)
           for r in freshness.dataset_metrics(log, marks, 0).collect()}
    assert got == {"tickets": (1_700_000_000, False), "notes": (200, True)}


def test_publish_marks(spark):
    orders = spark.createDataFrame([(i, f"o-{i}", "c", 5) for i in range(4)],
                                   "seq long, order_id string, customer_id string, amount_kobo long") \
        .withColumn("created_at", F.timestamp_seconds(F.lit(100) - F.col("seq")))
    rows = capture.outbox(capture.after_images(capture.created_orders(orders)))
    batch = capture.next_to_publish(rows, 2)
    assert [r.aggregate_id for r in batch.collect()] == ["o-3", "o-2"]
    failed = capture.mark_published(rows, batch, F.lit("2024-01-01").cast("timestamp"), errors=1)
    assert {r.aggregate_id: (r.publish_attempts, r.published_at) for r in failed.collect()} == {
        "o-3": (1, None), "o-2": (1, None), "o-1": (0, None), "o-0": (0, None)}
    done = capture.mark_published(failed, batch, F.lit("2024-01-01").cast("timestamp"))
    assert [r.aggregate_id for r in capture.next_to_publish(done, 9).collect()] == ["o-1", "o-0"]
    assert done.where("aggregate_id = 'o-3'").first().publish_attempts == 2


def test_update_of_a_missing_order_creates_it(spark):
    patches = spark.createDataFrame([(1, "x", "PAID", "ignored")],
                                    "seq long, order_id string, status string, note string") \
        .withColumn("created_at", F.timestamp_seconds(F.lit(0)))
    row = capture.after_images(capture.patched_orders(patches)).first()
    assert (row.customer_id, row.amount_kobo, row.currency, row.status) == ("unknown", 0, "NGN", "PAID")


def test_reconcile_and_new_keys(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v long")
    right = spark.createDataFrame([("a", 1), ("b", 3), ("d", 1)], "k string, v long")
    got = {r.outcome: r.rows for r in quality.reconcile(left, right, ["k"], ["v"]).collect()}
    assert got == {"match": 1, "mismatch": 1, "only_source": 1, "only_target": 1}
    payloads = spark.createDataFrame([(1, '{"a":1}'), (2, '{"a":1,"b":2}')], "n long, p string")
    keys = {r.key: (r.rows, r.first_seen, r.is_new)
            for r in quality.payload_keys(payloads, "p", ["a"], "n").collect()}
    assert keys == {"a": (2, 1, False), "b": (1, 2, True)}


def test_scratch_folder_comes_from_the_session(spark):
    base = spark.conf.get(CHECKPOINT_SETTING, None)
    path = scratch_dir(spark, "x")
    assert path.startswith(base.rstrip("/") + "/x-") if base else "eventlake-scratch/x-" in path
    assert scratch_dir(spark, "x") != path


def test_a_retry_after_midnight_replaces_the_batch(spark, tmp_path):
    """The ingest date comes from the messages, so it does not matter when the batch runs."""
    store = warehouse.Warehouse(spark, str(tmp_path))
    for _ in range(2):
        store.apply_batch(envelope(spark, (1, order("k1")), (86_500, order("k2", "o-2"))), "r", 0)
    lake = read_lake(spark, store.lake_path)
    assert sorted((r.offset, str(r.date)) for r in lake.collect()) == [(1, "1970-01-02"), (86_500, "1970-01-02")]
