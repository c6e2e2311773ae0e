"""Keys of any size: the chunked road gives the same rows as the plain one, and as a simulation."""

import random

import pytest
from pyspark.sql import Window, functions as F

from eventlake.operators.capture import assign_versions
from eventlake.operators.features import (
    feature_changelog, features_as_of, latest_features, unify)
from eventlake.operators.heavy import first_per_key, forward_fill, heavy_keys, in_chunks, running_max
from eventlake.operators.index import apply_changes, index_rows
from simulate import indexed, member_snapshots, versions

PLAIN, CHUNKED = 10**9, 7


def rows(df):
    return sorted((tuple(sorted(r.asDict().items(), key=str)) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def log():
    """Mutations of which one key owns more than a third."""
    rnd = random.Random(5)
    keys = ["hot"] * 4 + [f"r{i}" for i in range(6)]
    return [("d", rnd.choice(keys), rnd.choice(["upsert"] * 4 + ["delete"]), f"p{i}", i + 1, 1000 + i)
            for i in range(400)]


@pytest.fixture(scope="module")
def mutations(spark, log):
    return spark.createDataFrame(log, "dataset string, record_id string, op string, payload string, "
                                      "seq long, event_ts long")


@pytest.mark.parametrize("heavy_rows", [PLAIN, CHUNKED, 1])
def test_versions_equal_simulation(mutations, log, heavy_rows):
    got = assign_versions(mutations, heavy_rows=heavy_rows).orderBy("seq").collect()
    assert [r.version for r in got] == versions([(m[1], m[2]) for m in log])
    assert all((r.payload is None) == (r.op == "delete") for r in got)


def test_heavy_keys_are_exact(mutations):
    assert [r.record_id for r in heavy_keys(mutations, ["record_id"], 100).collect()] == ["hot"]


def test_light_road_needs_one_window_and_no_join_of_the_rows(mutations):
    plan = assign_versions(mutations)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("heavy_rows", [PLAIN, CHUNKED, 1])
def test_forward_fill(spark, heavy_rows):
    rnd = random.Random(3)
    data = [(rnd.choice("aaab"), i, rnd.choice([None, None, i]), rnd.choice([None, f"v{i}"]))
            for i in range(200)]
    df = spark.createDataFrame(data, "k string, seq long, x long, y string")
    state, expected = {}, []
    for k, seq, x, y in data:
        old = state.get(k, (None, None))
        state[k] = (x if x is not None else old[0], y if y is not None else old[1])
        expected.append((k, seq, *state[k]))
    got = forward_fill(df, ["k"], "seq", ["x", "y"], heavy_rows).select("k", "seq", "x", "y")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected


@pytest.mark.parametrize("heavy_rows", [PLAIN, CHUNKED, 1])
def test_running_max_equals_one_window(spark, heavy_rows):
    df = spark.range(300).select((F.col("id") * 3).alias("arrival"), (F.col("id") * 37 % 101).alias("v"))
    whole = Window.orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    expected = df.withColumn("m", F.max("v").over(whole))
    assert rows(running_max(df, "arrival", "v", "m", heavy_rows)) == rows(expected)


def test_first_per_key(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("k"), F.col("id").alias("n"))
    got = {}
    for r in first_per_key(df, "k", "n", 20, lanes=4).collect():
        got.setdefault(r.k, []).append(r.n)
    assert sorted(got["hot"]) == [i for i in range(1000) if i % 3 == 0][:20]
    assert sorted(got["cold"]) == [i for i in range(1000) if i % 3][:20]


def member_log(seed, count, span_ms):
    rnd = random.Random(seed)
    out, base = [], 1_700_000_000_000
    for seq in range(count):
        member = rnd.choice(["m0"] * 3 + ["m1", "m2"])
        ts = base + rnd.randrange(span_ms)
        if rnd.random() < 0.3:  # many events share a minute, some a millisecond
            ts = base + rnd.randrange(3)
        if rnd.random() < 0.5:
            out.append(("ACTIVITY", member, rnd.choice(["play", "browse", "search", "Play", None]),
                        None, ts, seq))
        else:
            out.append(("MESSAGE", member, rnd.choice(["sent", "open", "click", "delivered", ""]),
                        rnd.choice(["push", "email", "interstitial", None]), ts, seq))
    return out


EVENTS = "kind string, member_id string, event_type string, channel string, ts_ms long, seq long"


@pytest.mark.parametrize("heavy_rows", [PLAIN, 40, 1])
@pytest.mark.parametrize("span_ms", [3 * 3_600_000, 9 * 86_400_000])
def test_changelog_equals_simulation(spark, heavy_rows, span_ms):
    log = member_log(11, 250, span_ms)
    expected = []
    for member in {e[1] for e in log}:
        mine = sorted((e for e in log if e[1] == member), key=lambda e: (e[4], e[5]))
        expected += [{"member_id": member, **s}
                     for s in member_snapshots([(e[0], *e[2:]) for e in mine])]
    got = [r.asDict() for r in feature_changelog(
        spark.createDataFrame(log, EVENTS), heavy_rows=heavy_rows).collect()]
    by_seq = lambda r: r["seq"]
    assert sorted(got, key=by_seq) == sorted(expected, key=by_seq)


@pytest.mark.parametrize("heavy_rows", [PLAIN, 40, 1])
def test_timer_rows_equal_snapshots_as_of_the_boundary(spark, heavy_rows):
    log = member_log(4, 60, 2 * 3_600_000)
    events = spark.createDataFrame(log, EVENTS)
    timers = feature_changelog(events, timers=True, heavy_rows=heavy_rows).where("kind = 'TIMER'")
    got = [r.asDict() for r in timers.drop("kind", "seq").collect()]
    assert {(g["member_id"], g["snapshot_ts_ms"]) for g in got} == {
        (e[1], (e[4] // 300_000 + 1) * 300_000) for e in log}
    for moment in sorted({g["snapshot_ts_ms"] for g in got})[::8]:
        as_of = {r.member_id: r.asDict() for r in features_as_of(events, moment).collect()}
        assert all(g == as_of[g["member_id"]] for g in got if g["snapshot_ts_ms"] == moment)


def test_last_send_follows_arrival_or_time(spark):
    events = spark.createDataFrame(
        [("MESSAGE", "m", "sent", "push", 5000, 1), ("MESSAGE", "m", "sent", "push", 3000, 2)], EVENTS)
    by_time = features_as_of(events, 10_000).first()
    by_arrival = features_as_of(events, 10_000, arrival_order=True).first()
    assert by_time.last_sent_ts_by_channel == {"push": 5000}
    assert by_arrival.last_sent_ts_by_channel == {"push": 3000}


def test_latest_equals_as_of_the_last_event(spark):
    events = spark.createDataFrame(member_log(8, 120, 86_400_000), EVENTS)
    latest = {r.member_id: r.asDict() for r in latest_features(feature_changelog(events)).collect()}
    for member, row in latest.items():
        moment = row["snapshot_ts_ms"]
        same = features_as_of(events.where(F.col("member_id") == member), moment).first().asDict()
        assert row == same


def test_unify_normalises_message_types(spark):
    activity = spark.createDataFrame([("m", "Play", 1, 1)],
                                     "member_id string, event_type string, ts_ms long, seq long")
    messages = spark.createDataFrame(
        [("m", "SENT", "push", 2, 2), ("m", None, None, 3, 3)],
        "member_id string, event_type string, channel string, ts_ms long, seq long")
    got = {(r.kind, r.event_type) for r in unify(activity, messages).collect()}
    assert got == {("ACTIVITY", "Play"), ("MESSAGE", "sent"), ("MESSAGE", "")}


def test_index_equals_one_by_one(spark, mutations, log):
    events = assign_versions(mutations).withColumn("offset", F.col("seq"))
    ordered = [(r.record_id, r.op, r.payload, r.version) for r in events.orderBy("seq").collect()]
    expected = indexed(ordered)
    whole = index_rows(events, F.lit(9).cast("long"))
    assert {r.record_id: (r.payload, r.version, r.tombstone) for r in whole.collect()} == expected
    first = index_rows(events.where("offset <= 150"), F.lit(9).cast("long"))
    stepped = apply_changes(first, events.where("offset > 100"), F.lit(10).cast("long"))
    assert {r.record_id: (r.payload, r.version, r.tombstone) for r in stepped.collect()} == expected


def test_sparse_sequences_make_no_more_chunks(spark):
    """1,000 numbers spaced by 2^22: as many chunks as their rank asks for, in order."""
    df = spark.range(1000).select((F.col("id") * (1 << 22)).alias("seq"))
    parts = in_chunks(df, ["seq"], heavy_rows=100).groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("low"), F.max("seq").alias("high")).orderBy("chunk").collect()
    assert 8 <= len(parts) <= 10 and max(p.n for p in parts) < 250
    assert all(a.high < b.low for a, b in zip(parts, parts[1:]))
