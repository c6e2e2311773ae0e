"""Digest trees, frequent keys, and stream twins of batch reports."""

import json
import random

import pytest
from pyspark.sql import functions as F

from eventlake.operators import features, index, quality, rollups
from eventlake.session import streaming_session
from eventlake.sources.schemas import CHANGE_EVENT
from eventlake.sources.streams import file_stream
from eventlake.streaming import late, progress, rollups as rollup_streams, sinks, spikes
from simulate import member_snapshots


@pytest.fixture(scope="module")
def session(spark):
    return streaming_session(spark)


def numbered(spark, n, changed=(), missing=()):
    rows = spark.range(n).select(F.concat(F.lit("k"), F.col("id")).alias("k"), (F.col("id") * 7 % 100).alias("v"))
    return rows.where(~F.substring("k", 2, 9).cast("long").isin(list(missing) or [-1])).withColumn(
        "v", F.when(F.substring("k", 2, 9).cast("long").isin(list(changed) or [-1]), -1).otherwise(F.col("v")))


def test_digest_tree_reads_rows_under_unequal_leaves_only(spark):
    source, target = numbered(spark, 5000, missing=[77]), numbered(spark, 5000, changed=[5, 4000], missing=[1234])
    trees = [quality.digests(side, ["k"], ["v"], 12) for side in (source, target.repartition(7))]
    leaves = {r.node for r in quality.unequal_leaves(*trees, 12, 5).collect()}
    expected = {r.n for r in spark.createDataFrame([("k5",), ("k77",), ("k1234",), ("k4000",)], "k string").select(
        F.shiftrightunsigned(F.xxhash64("k"), 52).alias("n")).collect()}
    assert leaves == expected and len(leaves) == 4
    got = {r.outcome: r.rows for r in quality.reconcile_tree(source, target, ["k"], ["v"], 12).collect()}
    assert got == {r.outcome: r.rows for r in quality.reconcile(source, target, ["k"], ["v"]).collect()}
    assert got == {"match": 4996, "mismatch": 2, "only_source": 1, "only_target": 1}


def test_digest_tree_of_equal_empty_and_repeated_rows(spark):
    rows = numbered(spark, 300)
    assert quality.unequal_leaves(quality.digests(rows, ["k"], ["v"]), quality.digests(rows.repartition(3), ["k"], ["v"])).count() == 0
    assert {r.outcome: r.rows for r in quality.reconcile_tree(rows, rows.limit(0), ["k"], ["v"], 8).collect()} == {"only_source": 300}
    assert quality.reconcile_tree(rows.limit(0), rows.limit(0), ["k"], ["v"], 8).count() == 0
    twice = rows.union(rows.limit(1))  # a repeated row is seen by the number of rows
    assert quality.unequal_leaves(quality.digests(rows, ["k"], ["v"]), quality.digests(twice, ["k"], ["v"])).count() == 1


def test_every_key_above_the_threshold_is_found_without_counting_the_rest(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 10 == 0, "hot").when(F.col("id") % 50 == 1, "warm").otherwise(F.concat(F.lit("x"), F.col("id"))).alias("k"),
        F.lit(None).cast("string").alias("none"))
    found = rollups.hot_keys(rows, ["k", "none"], 0.02)
    assert {r.k: r.rows for r in found.collect()} == {"hot": 20_000, "warm": 4_000}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan  # rows of other keys are gone before the grouping
    assert rollups.hot_keys(rows.limit(0), ["k", "none"], 0.02).count() == 0
    with pytest.raises(ValueError):
        rollups.hot_keys(rows, ["k"], 0.02, tracked=16)


def test_late_rows_go_on_from_the_mark_and_a_retry_replaces(spark, session, tmp_path):
    ddl = "id long, arrival long, s long"
    rows = [(i, i, (i * 37 % 11) * 60 + i * 30) for i in range(60)]
    whole = session.createDataFrame(rows, ddl).withColumn("ts", F.timestamp_seconds("s"))
    split = late.LateSplit(session, str(tmp_path / "late"), 60, 2)
    for batch_id, (first, last) in enumerate([(0, 25), (25, 26), (26, 60)]):
        part = whole.where(F.col("arrival").between(first, last - 1))
        for _ in range(2):
            split.write(part, batch_id)
    expected = {r.id: r.is_late for r in rollups.late_audit(whole, 60, 2).collect()}
    assert {r.id: r.is_late for r in split.rows().collect()} == expected and any(expected.values())
    assert {r.reason for r in split.rows(late=True).collect()} == {late.LATE_REASON}
    assert split.rows(late=False).where("reason IS NOT NULL").count() == 0
    assert split.mark(2) == max(s for _, _, s in rows) * 1_000_000
    split.write(whole.limit(0), 3)  # an empty micro-batch keeps the mark
    assert split.mark(3) == split.mark(2)


def follow(session, tmp_path, batches, ddl, build, name):
    """Run ``build`` over files that come one after the other, one micro-batch each."""
    folder = str(tmp_path / f"in-{name}")
    schema = session.createDataFrame([], ddl).withColumn("ts", F.timestamp_seconds("s")).schema
    seen = []
    for rows in batches:
        session.createDataFrame(rows, ddl).withColumn("ts", F.timestamp_seconds("s")).coalesce(1).write.mode("append").parquet(folder)
        stream = file_stream(session, folder, schema, max_files_per_trigger=1)
        frame = build(stream)
        sinks.to_files(frame, str(tmp_path / f"out-{name}"), str(tmp_path / f"check-{name}")).awaitTermination()
        seen.append(session.read.schema(frame.schema).parquet(str(tmp_path / f"out-{name}")).collect())
    return seen


def test_an_outage_is_reported_while_it_lasts(session, tmp_path):
    ddl = "metric string, s long"
    steady = [("up", w * 60) for w in range(30) for _ in range(4)] + [("down", w * 60) for w in range(10) for _ in range(4)]
    tick, back = [("up", 30 * 60 + 61)], [("down", 33 * 60), ("up", 40 * 60)]
    seen = follow(session, tmp_path, [steady, tick, back], ddl,
                  lambda s: spikes.spike_stream(s, ["metric"], 60, "0 seconds", trailing=5), "spikes")
    window = lambda r: int(r.window_start.timestamp()) // 60
    # "down" is silent and "up" moves the clock: five windows are reported, after which nothing can be told
    assert sorted(window(r) for r in seen[1] if r.metric == "down") == list(range(15))
    flags = {(r.metric, window(r)): r for r in seen[-1]}
    assert len(flags) == len(seen[-1])  # every window once
    assert [w for (m, w), r in sorted(flags.items()) if m == "down" and w < 33 and r.is_drop] == [10, 11, 12, 13, 14]
    # it speaks again: the windows between are reported, and the first count is a spike
    assert {w for m, w in flags if m == "down"} >= set(range(34)) and flags["down", 33].value == 1 and flags["down", 33].is_spike
    assert not any(r.is_drop or r.is_spike for (m, w), r in flags.items() if m == "up" and w < 30)
    assert flags["down", 10].trailing_mean == 4.0 and flags["down", 10].trailing_points == 5


def test_sliding_sketches_stay_within_their_bound(session, tmp_path):
    ddl = "user_id string, s long"
    rows = [(f"u{i * 31 % 700}", i // 3) for i in range(2400)]
    batch = {r.window_start: r.uniques for r in rollups.sliding_uniques(
        session.createDataFrame(rows, ddl).withColumn("ts", F.timestamp_seconds("s")), 300, 60).collect()}
    batches = [rows[:900], rows[900:], [(None, 10_000)]]
    exact = follow(session, tmp_path, batches, ddl, lambda s: rollup_streams.sliding_uniques(s, 300, 60, 5), "exact")[-1]
    assert {r.window_start: r.uniques for r in exact} == batch
    sketched = follow(session, tmp_path, batches, ddl, lambda s: rollup_streams.sliding_sketches(s, 300, 60, 5), "sketch")[-1]
    assert {r.window_start for r in sketched} == set(batch)
    assert all(abs(r.uniques - batch[r.window_start]) <= max(1, rollups.SKETCH_ERROR * batch[r.window_start]) for r in sketched)
    with pytest.raises(ValueError):
        rollup_streams.sliding_uniques(session.createDataFrame(rows, ddl), 300, 90)


def test_reports_hold_counts_by_reason_and_offsets_behind(spark):
    report = {"id": "q", "batchId": 1, "observedMetrics": {"records": {"good": 8, "malformed_json": 2, "other": 0}}, "sources": [
        {"endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": {"t": {"0": 9, "1": 7, "2": 3}}}, {"endOffset": {"logOffset": 3}, "latestOffset": None}]}
    row = dict(zip(progress.PROGRESS.names, progress.progress_row(json.loads(json.dumps(report)))))
    assert (row["good"], row["rejected"], row["offsets_behind"]) == (8, {"malformed_json": 2}, 7)
    assert progress.offsets_behind({"latestOffset": None, "endOffset": None}) is None
    rows = [progress.progress_row(report), progress.progress_row({**report, "batchId": 2}), progress.progress_row({"id": "other", "batchId": 0})]
    rates = progress.error_rates(spark.createDataFrame(rows, progress.PROGRESS)).collect()
    assert [(r.query, r.reason, r.rejected, r.records, r.error_rate) for r in rates] == [("q", "malformed_json", 4, 20, 0.2)]


@pytest.mark.parametrize("heavy_rows", [1_000_000, 40])
def test_any_number_of_channels(spark, monkeypatch, heavy_rows):
    """Rows per channel instead of a column each give what one-by-one simulation does."""
    rnd = random.Random(6)
    log = []
    for i in range(160):
        kind, event = rnd.choice([("ACTIVITY", "play"), ("MESSAGE", "sent"), ("MESSAGE", "sent"), ("MESSAGE", "open")])
        channel = None if kind == "ACTIVITY" else f"c{rnd.randrange(30)}" if rnd.random() < 0.8 else rnd.choice(["push", "email"])
        log.append((kind, f"m{rnd.randrange(2)}", event, channel, 1_700_000_000_000 + i * rnd.choice([1, 60_000, 3_600_000]) // 2, i))
    events = spark.createDataFrame(log, "kind string, member_id string, event_type string, channel string, ts_ms long, seq long")
    monkeypatch.setattr(features.sent_channels, "__defaults__", (5,))
    assert features.sent_channels(events) is None
    got = [r.asDict() for r in features.feature_changelog(events, heavy_rows=heavy_rows).collect()]
    expected = []
    for member in ("m0", "m1"):
        mine = sorted((e for e in log if e[1] == member), key=lambda e: (e[4], e[5]))
        expected += [{"member_id": member, **s} for s in member_snapshots([(e[0], *e[2:]) for e in mine])]
    by_seq = lambda r: r["seq"]
    assert sorted(got, key=by_seq) == sorted(expected, key=by_seq)


def test_a_silent_key_is_followed_for_the_trailing_windows_only(spark):
    rows = [("a", 0), ("b", 0), ("b", 100_000)]
    series = spark.createDataFrame(rows, "k string, w long").select("k", F.timestamp_seconds(F.col("w") * 60).alias("window_start"), F.lit(5).cast("long").alias("n"))
    got = {r.k: r["count"] for r in rollups.spikes(series, ["k"], "n", 60, trailing=10).groupBy("k").count().collect()}
    assert got == {"a": 11, "b": 100_001}


def test_control_rows_of_the_index_are_read_alone(spark, tmp_path):
    store = index.IndexStore(spark, str(tmp_path))
    log = spark.createDataFrame([(i, "d", f"r{i % 7}", "upsert", f"p{i}", i, i) for i in range(1, 40)], CHANGE_EVENT)
    for batch in range(3):
        store.apply_batch(log.where(F.col("offset") % 3 == batch), 7, "run", batch)
        store.compact()
    store.apply_batch(log.limit(0), 7, "run", 3)
    assert store.index().count() == 7 and store.checkpoints().first().last_offset == 39
    plan = store.checkpoints()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"= {index.CONTROL_PART}" in plan
    sizes = sorted({int(f.split("segment=")[1].split("/")[0]) for f in store.table.batches().inputFiles() if "/closed/" in f})
    assert sizes == [0, 1, 2]  # one segment per compaction, each written once
