"""Lag and health of the datasets of a change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventlake.operators.joins import checked_broadcast

FRESHNESS_SLO_SECONDS = 300


def log_heads(log: DataFrame) -> DataFrame:
    """Newest event time and highest offset per dataset."""
    return log.groupBy("dataset").agg(
        F.max("event_ts").alias("max_event_ts"), F.max("offset").alias("max_offset"))


def dataset_metrics(log: DataFrame, checkpoints: DataFrame, as_of_s: int,
                    slo_seconds: int = FRESHNESS_SLO_SECONDS) -> DataFrame:
    """Freshness lag, backlog and verdict per dataset.

    A dataset without a checkpoint event time (never read, or just reset) lags by its whole head
    time and is not ok. The backlog is a difference of offsets, which all datasets share.
    """
    marks = checkpoints.select(
        "dataset", F.col("last_event_ts").alias("checkpoint_last_event_ts"),
        F.col("last_offset").alias("checkpoint_last_offset"),
        F.col("updated_at").alias("checkpoint_updated_at"))
    joined = log_heads(log).join(marks, "dataset", "full")
    filled = joined.fillna(0, [c for c in joined.columns if c != "dataset"])
    head, seen = F.col("max_event_ts"), F.col("checkpoint_last_event_ts")
    return filled.withColumns({
        "now": F.lit(as_of_s).cast("long"),
        "freshness_lag_seconds": F.when(
            (head != 0) & (seen != 0), F.greatest(F.lit(0), head - seen)).otherwise(head),
        "backlog_offsets": F.greatest(
            F.lit(0), F.col("max_offset") - F.col("checkpoint_last_offset")),
        "freshness_slo_seconds": F.lit(slo_seconds).cast("long"),
    }).withColumn("ok", F.col("freshness_lag_seconds") <= F.col("freshness_slo_seconds"))


def _verdict() -> list[Column]:
    return [
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"),
        F.count(F.lit(1)).alias("datasets"),
        F.count_if(~F.col("ok")).alias("stale_datasets"),
        F.max("freshness_lag_seconds").alias("worst_lag_seconds"),
        F.max("backlog_offsets").alias("worst_backlog")]


def health(metrics: DataFrame) -> DataFrame:
    """One row: are all datasets ok, how many are not, and the worst lag and backlog."""
    return metrics.agg(*_verdict())


def health_report(metrics: DataFrame) -> DataFrame:
    """The health answer whole: ``health`` and ``rows``, the metrics of every dataset ordered by name.

    ``rows`` has one entry per dataset, whose number does not grow with the log.
    """
    columns = ["dataset", *sorted(c for c in metrics.columns if c != "dataset")]
    return metrics.agg(*_verdict(), F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"))


def run_counters(log: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows handled per dataset of the log in one run, 0 for datasets with nothing to do."""
    done = checked_broadcast(processed.select("dataset", "processed"))
    return log.select("dataset").distinct().join(done, "dataset", "left").fillna(0, ["processed"])
