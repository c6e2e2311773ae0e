"""Read-side views over rollups and current-state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HISTORY_DEFAULT_LIMIT = 200
HISTORY_MAX_LIMIT = 2_000
LATEST_TTL_SECONDS = 600
RECENT_ORDERS_LIMIT = 20


def history(rollups: DataFrame, metric: str, from_ts: Column, to_ts: Column,
            limit: int = HISTORY_DEFAULT_LIMIT) -> DataFrame:
    """Rollups of one metric with ``from_ts <= window_start < to_ts``, newest first."""
    if not 1 <= limit <= HISTORY_MAX_LIMIT:
        raise ValueError(f"limit must be 1 to {HISTORY_MAX_LIMIT}, not {limit}")
    wanted = rollups.where((F.col("metric") == F.lit(metric))
                           & (F.col("window_start") >= from_ts) & (F.col("window_start") < to_ts))
    return wanted.orderBy(F.desc("window_start"), "dims_hash").limit(limit)


def latest(rollups: DataFrame, metric: str | None = None) -> DataFrame:
    """The newest window of every (metric, dimensions)."""
    if metric is not None:
        rollups = rollups.where(F.col("metric") == F.lit(metric))
    values = [c for c in rollups.columns if c not in ("metric", "dims_hash")]
    return rollups.groupBy("metric", "dims_hash").agg(
        F.max_by(F.struct(*values), "window_start").alias("newest")
    ).select("metric", "dims_hash", "newest.*")


def unexpired(rollups: DataFrame, as_of: Column, ttl_seconds: int = LATEST_TTL_SECONDS) -> DataFrame:
    """Rows of the metrics written to within the last ``ttl_seconds``; a metric expires as a whole."""
    cutoff = F.timestamp_seconds(F.unix_seconds(as_of) - F.lit(ttl_seconds))
    live = rollups.groupBy("metric").agg(F.max("updated_at").alias("touched_at")) \
        .where(F.col("touched_at") >= cutoff).select("metric")
    return rollups.join(live, "metric", "left_semi")


def window_set(rollups: DataFrame, metric: str, window_start: Column) -> DataFrame:
    """All dimension rows of one window of one metric."""
    return rollups.where((F.col("metric") == F.lit(metric))
                         & (F.col("window_start") == window_start))


def recent_orders(orders: DataFrame, limit: int = RECENT_ORDERS_LIMIT,
                  by: str = "updated_at") -> DataFrame:
    """The most recently updated orders."""
    return orders.orderBy(F.desc(by), "order_id").limit(limit)
