"""Tumbling and sliding rollups of metric events."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlake.functions.keys import clean_dim, dims_as_map, dims_hash, dims_json
from eventlake.functions.times import window_end, window_start
from eventlake.operators.heavy import HEAVY_ROWS, running_max
from eventlake.session import stored

DEFAULT_DIMS = ("customer_id", "endpoint", "status", "event_type")
DEFAULT_WINDOW_SECONDS = 60
LATENESS_WINDOWS = 5
SKETCH_ERROR = 0.05  # of a user sketch at its default precision, about three standard errors
ROLLUP_KEY = ("window_start", "window_end", "metric", "dims_hash")


def exact_sum(value: Column, sum_type: str | None) -> Column:
    """Sum of a double. ``sum_type`` (a decimal type) makes it independent of row order."""
    if sum_type is None:
        return F.sum(value)
    return F.sum(value.cast(sum_type)).cast("double")


def person(user: Column) -> Column:
    """A user id that counts: empty text is no user."""
    return F.nullif(user.cast("string"), F.lit(""))


def clean_dim_columns(events: DataFrame, dims: Sequence[str]) -> DataFrame:
    return events.withColumns({d: clean_dim(F.col(d)) for d in dims})


def with_dims_key(rollups: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Swap the dimension columns for ``dims`` (a map) and ``dims_hash``.

    Runs on finished rollup rows: the events group on the plain columns, so text is hashed once per
    result row instead of once per event.
    """
    columns = {d: F.col(d) for d in dims}
    return rollups.withColumns({"dims": dims_as_map(columns), "dims_text": dims_json(columns)}) \
        .withColumn("dims_hash", dims_hash(F.col("dims_text"))).drop("dims_text", *dims)


def rollup(events: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS,
           dims: Sequence[str] = DEFAULT_DIMS, sum_type: str | None = None,
           dedupe: str | None = None) -> DataFrame:
    """Count, sum and exact unique users per (metric, window, dimensions).

    The distinct count is planned in two steps, first by (group, user), so one dominant group is
    spread over the cluster by its users. ``dedupe`` names an id column; repeated deliveries then
    count once.
    """
    if dedupe:
        events = events.dropDuplicates([dedupe])
    cells = clean_dim_columns(events, dims).select(
        "metric", window_start(F.col("ts"), window_seconds).alias("window_start"), *dims,
        "value", person(F.col("user_id")).alias("user_id"))
    totals = cells.groupBy("metric", "window_start", *dims).agg(
        F.count(F.lit(1)).alias("count"),
        exact_sum(F.col("value"), sum_type).alias("sum"),
        F.countDistinct("user_id").alias("uniques"),
    )
    return with_dims_key(totals, dims).select(
        "window_start", window_end(F.col("window_start"), window_seconds).alias("window_end"),
        "metric", "dims_hash", "dims", "count", "sum", "uniques")


def stamp(rollups: DataFrame, updated_at: Column) -> DataFrame:
    """Rollup rows as stored: with the time of the flush that wrote them."""
    return rollups.withColumn("updated_at", updated_at)


def rollup_sketches(events: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS,
                    dims: Sequence[str] = DEFAULT_DIMS, sum_type: str | None = None,
                    precision: int = 12) -> DataFrame:
    """Like ``rollup`` with a mergeable sketch of the users instead of their exact number."""
    cells = clean_dim_columns(events, dims).withColumn(
        "window_start", window_start(F.col("ts"), window_seconds))
    return cells.groupBy("metric", "window_start", *dims).agg(
        F.count(F.lit(1)).alias("count"),
        exact_sum(F.col("value"), sum_type).alias("sum"),
        F.hll_sketch_agg(person(F.col("user_id")), precision).alias("users_sketch"),
    )


def merge_sketches(sketches: DataFrame, window_seconds: int, keys: Sequence[str]) -> DataFrame:
    """Longer windows or fewer dimensions from finished sketch rows, without the events."""
    return sketches.withColumn("window_start", window_start(F.col("window_start"), window_seconds)) \
        .groupBy("window_start", *keys).agg(
            F.sum("count").alias("count"),
            F.sum("sum").alias("sum"),
            F.hll_sketch_estimate(F.hll_union_agg("users_sketch")).alias("uniques_estimate"))


def closed(rollups: DataFrame, as_of: Column, lag_seconds: int = 0) -> DataFrame:
    """Rollups whose window ended at least ``lag_seconds`` before ``as_of``."""
    cutoff = F.timestamp_seconds(F.unix_seconds(as_of) - F.lit(lag_seconds))
    return rollups.where(F.col("window_end") <= cutoff)


def count_by(events: DataFrame, keys: Sequence[str], window_seconds: int, name: str,
             sum_name: str | None = None, sum_type: str | None = None) -> DataFrame:
    """Events per window and key columns, with an optional sum of ``value``."""
    windowed = events.withColumn("window_start", window_start(F.col("ts"), window_seconds))
    measures = [F.count(F.lit(1)).alias(name)]
    if sum_name:
        measures.append(exact_sum(F.col("value"), sum_type).alias(sum_name))
    return windowed.groupBy("window_start", *keys).agg(*measures)


def error_rate(events: DataFrame, window_seconds: int, first_error_status: int = 400) -> DataFrame:
    """Share of failed requests per endpoint and window; events without a status are not requests."""
    requests = clean_dim_columns(events, ("endpoint", "status")).where(F.col("status").isNotNull())
    failed = F.col("status").try_cast("int") >= first_error_status
    return requests.withColumn("window_start", window_start(F.col("ts"), window_seconds)) \
        .groupBy("window_start", "endpoint").agg(
            F.count(F.lit(1)).alias("requests"), F.count_if(failed).alias("errors")) \
        .withColumn("error_rate", F.col("errors") / F.col("requests"))


def sliding_uniques(events: DataFrame, window_seconds: int = 300,
                    slide_seconds: int = 60) -> DataFrame:
    """Distinct users in every sliding window ``[start, start + window)`` that has any.

    Users are reduced to one row per slide first; only those rows are copied to the windows they
    belong to. Where the slide does not divide the window, the first part of a slide belongs to one
    window more, so it is kept apart.
    """
    steps, rest = divmod(window_seconds, slide_seconds)
    slide = window_start(F.col("ts"), slide_seconds)
    early = F.unix_seconds("ts") - F.unix_seconds(slide) < rest
    seen = events.where(person(F.col("user_id")).isNotNull()).select(
        slide.alias("slide"), early.alias("early"), "user_id").distinct()
    last = F.when(F.col("early"), steps).otherwise(steps - 1)
    seen = seen.where(last >= 0)
    ends = F.explode(F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.timestamp_seconds(F.unix_seconds("slide") - i * F.lit(slide_seconds))))
    return seen.select(ends.alias("window_start"), "user_id").groupBy("window_start").agg(
        F.countDistinct("user_id").alias("uniques")) \
        .withColumn("window_end", window_end(F.col("window_start"), window_seconds))


def without_gaps(series: DataFrame, keys: Sequence[str], value: str, window_seconds: int,
                 behind: int | None = None) -> DataFrame:
    """``series`` with a zero for every window without a row, from a key's first window to the last
    window of the whole series, but no more than ``behind`` windows behind the key's own last row."""
    last = F.unix_seconds(series.agg(F.max("window_start")).scalar())
    first = series.groupBy(*keys).agg(F.min("window_start").alias("first"), F.max("window_start").alias("latest"))
    if behind is not None:
        last = F.least(last, F.unix_seconds("latest") + behind * window_seconds)
    starts = F.sequence(F.unix_seconds("first"), last, F.lit(window_seconds).cast("long"))
    calendar = first.select(*keys, F.explode(starts).alias("at")).select(
        *keys, F.timestamp_seconds("at").alias("window_start"))
    return calendar.join(series, [*keys, "window_start"], "left").fillna(0, [value])


def spikes(series: DataFrame, keys: Sequence[str], value: str, window_seconds: int, trailing: int = 24,
           factor: float = 2.0, slo: float | None = None) -> DataFrame:
    """Flag points far above or below the mean of the ``trailing`` windows before them.

    ``series`` has at most one row per key and window, so its size follows the calendar, not the
    events. A window without a row counts as zero, so an outage is a drop. A key that stays silent is
    followed for ``trailing`` windows, after which its mean is zero and nothing can be told any more.
    """
    series = without_gaps(series, keys, value, window_seconds, trailing)
    before = Window.partitionBy(*keys).orderBy("window_start").rowsBetween(-trailing, -1)
    flagged = series.withColumns({
        "trailing_mean": F.avg(value).over(before),
        "trailing_points": F.count(value).over(before),
    })
    full = F.col("trailing_points") == trailing
    flagged = flagged.withColumns({
        "is_spike": full & (F.col(value) > F.col("trailing_mean") * F.lit(factor)),
        "is_drop": full & (F.col(value) * F.lit(factor) < F.col("trailing_mean")),
    }).withColumns({c: F.coalesce(c, F.lit(False)) for c in ("is_spike", "is_drop")})
    if slo is not None:
        flagged = flagged.withColumn("violates_slo", F.col(value) > F.lit(slo))
    return flagged


def key_shares(events: DataFrame, keys: Sequence[str], threshold: float) -> DataFrame:
    """Row share of every key, flagging those at or above ``threshold``."""
    counts = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("share", F.col("rows") / total) \
        .withColumn("is_hot", F.col("share") >= F.lit(threshold))


def hot_keys(events: DataFrame, keys: Sequence[str], threshold: float, tracked: int | None = None) -> DataFrame:
    """Every key with at least ``threshold`` of the rows, with its exact count, without counting the others.

    A mergeable frequent-items sketch of ``tracked`` keys is made in one pass: it errs by at most
    4 / ``tracked`` of the rows, so with 16 / ``threshold`` tracked keys or more none above the threshold
    can be missing among its ``tracked`` most frequent ones. Only rows of the keys it names, a list bounded
    by ``tracked``, are counted exactly.
    """
    least = 1 << max(3, math.ceil(math.log2(16 / threshold)))
    tracked = least if tracked is None else tracked
    if tracked < least:
        raise ValueError(f"{tracked} tracked keys can miss a key of {threshold:.2%}; {least} cannot")
    name = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    sketched = events.select(name.alias("key")).agg(
        F.expr(f"approx_top_k(key, {tracked // 2}, {tracked})").alias("found"), F.count(F.lit(1)).alias("total"))
    found = stored(sketched.select("total", F.explode_outer("found").alias("f")).select("total", "f.item", "f.count"))
    total = found.agg(F.max("total")).first()[0] or 0
    likely = found.where(F.col("count") >= F.lit((threshold - 4 / tracked) * total)).select(F.col("item").alias("key"))
    counted = events.withColumn("key", name).join(F.broadcast(likely), "key", "left_semi").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("share", F.col("rows") / F.lit(total)).where(F.col("share") >= F.lit(threshold))


def late_audit(events: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS,
               lateness_windows: int = LATENESS_WINDOWS, arrival: str = "arrival",
               heavy_rows: int = HEAVY_ROWS, seen_before_us: int | None = None) -> DataFrame:
    """Mark events whose window had already been given up when they arrived.

    The reference point is the largest event time on earlier arrivals; a window is given up
    ``lateness_windows`` windows after its end. ``seen_before_us`` is the largest event time that came
    before all of ``events``.
    """
    timed = events.withColumns({
        "ts_us": F.unix_micros("ts"),
        "window_start": window_start(F.col("ts"), window_seconds),
    })
    seen = running_max(timed, arrival, "ts_us", "seen_until_us", heavy_rows).withColumn(
        "seen_until_us", F.greatest(F.col("seen_until_us"), F.lit(seen_before_us).cast("long")))
    end_us = F.unix_micros("window_start") + F.lit(window_seconds * 1_000_000)
    delay_us = lateness_windows * window_seconds * 1_000_000
    return seen.withColumn(
        "is_late", F.coalesce(end_us <= F.col("seen_until_us") - F.lit(delay_us), F.lit(False))
    ).drop("ts_us")
