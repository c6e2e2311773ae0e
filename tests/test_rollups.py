from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventlake.operators import rollups, serving
from eventlake.functions.times import window_end, window_start

START = datetime(2025, 5, 4, 10, 20, 0)
EVENT = ("event_id string, event_type string, metric string, value double, user_id string, "
         "customer_id string, endpoint string, status string, ts timestamp")


def event(i, user="u1", customer="c1", second=0, value=1.0, metric="requests", status="200"):
    return (f"e{i}", "request", metric, value, user, customer, "/a", status,
            START + timedelta(seconds=second))


def test_tumbling_bounds(spark):
    df = spark.createDataFrame([(START + timedelta(seconds=59),)], "ts timestamp").select(
        window_start(F.col("ts"), 60).alias("s"))
    row = df.select("s", window_end(F.col("s"), 60).alias("e")).first()
    assert (row.s, row.e) == (START, START + timedelta(seconds=60))


def test_counts_and_uniques(spark):
    df = spark.createDataFrame([event(1), event(2, "u2"), event(3, "u2"), event(4, "", "c2"),
                                event(5, None, "c2")], EVENT)
    got = {r.dims["customer_id"]: (r["count"], r["sum"], r.uniques)
           for r in rollups.rollup(df, 60).collect()}
    assert got == {"c1": (3, 3.0, 2), "c2": (2, 2.0, 0)}
    ready = rollups.closed(rollups.rollup(df, 60), F.lit(START + timedelta(seconds=61)))
    assert ready.count() == 2
    assert rollups.closed(rollups.rollup(df, 60), F.lit(START + timedelta(seconds=59))).count() == 0


def test_blank_dimensions_do_not_split_groups(spark):
    df = spark.createDataFrame([event(1, status=" \t"), event(2, status=None), event(3, status="")], EVENT)
    rows = rollups.rollup(df, 60).collect()
    assert [(r["count"], "status" in r.dims) for r in rows] == [(3, False)]


def test_dedupe_counts_a_redelivery_once(spark):
    df = spark.createDataFrame([event(1), event(1), event(2)], EVENT)
    assert rollups.rollup(df, 60).first()["count"] == 3
    assert rollups.rollup(df, 60, dedupe="event_id").first()["count"] == 2


def test_sliding_windows_equal_brute_force(spark):
    data = [event(i, f"u{i % 7}", second=i * 41) for i in range(60)]
    got = {r.window_start: r.uniques for r in rollups.sliding_uniques(
        spark.createDataFrame(data, EVENT)).collect()}
    expected = {}
    for minute in range(-5, 45):
        start = START + timedelta(minutes=minute)
        users = {e[4] for e in data if start <= e[8] < start + timedelta(minutes=5)}
        if users:
            expected[start] = len(users)
    assert got == expected


def test_spikes_and_drops(spark):
    series = [("m", START + timedelta(minutes=i), v) for i, v in enumerate([10, 10, 10, 50, 2, 10])]
    df = spark.createDataFrame(series, "metric string, window_start timestamp, v long")
    rows = rollups.spikes(df, ["metric"], "v", 60, trailing=3, factor=2.0, slo=40).orderBy(
        "window_start").collect()
    assert [r.is_spike for r in rows] == [False, False, False, True, False, False]
    assert [r.is_drop for r in rows] == [False, False, False, False, True, True]
    assert [r.violates_slo for r in rows] == [False, False, False, True, False, False]


def test_late_events(spark):
    seconds = [0, 30, 500, 10, 400, 130]
    df = spark.createDataFrame([(i, START + timedelta(seconds=s)) for i, s in enumerate(seconds)],
                               "arrival long, ts timestamp")
    got = [r.is_late for r in rollups.late_audit(df, 60, 2).orderBy("arrival").collect()]
    assert got == [False, False, False, True, False, True]


def test_history_limits_and_latest(spark):
    df = spark.createDataFrame([event(i, second=i * 60) for i in range(5)], EVENT)
    rows = rollups.rollup(df, 60)
    newest = serving.history(rows, "requests", F.lit(START), F.lit(START + timedelta(minutes=4)), 2)
    assert [r.window_start.minute for r in newest.collect()] == [23, 22]
    assert serving.latest(rows, "requests").first().window_start.minute == 24
    for limit in (0, 2001):
        with pytest.raises(ValueError):
            serving.history(rows, "requests", F.lit(START), F.lit(START), limit)


def test_expiry_is_per_metric(spark):
    rows = spark.createDataFrame([("a", 1, START), ("a", 2, START - timedelta(hours=1)),
                                  ("b", 1, START - timedelta(seconds=601))],
                                 "metric string, n int, updated_at timestamp")
    assert {(r.metric, r.n) for r in serving.unexpired(rows, F.lit(START)).collect()} == {("a", 1), ("a", 2)}


def test_key_shares(spark):
    df = spark.range(10).select(F.when(F.col("id") < 4, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    got = {r.k: (r.share, r.is_hot) for r in rollups.key_shares(df, ["k"], 0.3).collect()}
    assert got["hot"] == (0.4, True) and got["9"] == (0.1, False)


def test_an_outage_is_a_drop(spark):
    """No row at all in the last window of one metric, while the other goes on."""
    hours = [START.replace(minute=0) + timedelta(hours=h) for h in range(31)]
    rows = [("a", t, 50) for t in hours[:30]] + [("b", t, 50) for t in hours]
    series = spark.createDataFrame(rows, "metric string, window_start timestamp, n long")
    flags = {(r.metric, r.window_start): r for r in rollups.spikes(series, ["metric"], "n", 3600).collect()}
    assert flags["a", hours[30]].is_drop and flags["a", hours[30]].n == 0
    assert not flags["b", hours[30]].is_drop and len(flags) == 62


@pytest.mark.parametrize("window,slide", [(300, 90), (300, 60), (60, 60), (100, 70)])
def test_sliding_windows_equal_sparks_own(spark, window, slide):
    rows = [event(i, user=f"u{i % 7}", second=i * 37) for i in range(60)]
    df = spark.createDataFrame(rows, EVENT)
    got = {(r.window_start, r.uniques) for r in rollups.sliding_uniques(df, window, slide).collect()}
    own = df.groupBy(F.window("ts", f"{window} seconds", f"{slide} seconds")).agg(F.countDistinct("user_id").alias("n"))
    assert got == {(r["window"].start, r.n) for r in own.collect()}
