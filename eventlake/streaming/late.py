"""Late rows of a stream, kept apart with a reason instead of being dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.operators.rollups import DEFAULT_WINDOW_SECONDS, LATENESS_WINDOWS, late_audit
from eventlake.sources.schemas import record
from eventlake.streaming.sinks import each_batch

LATE_REASON = "window_given_up"
MARK = record(seen_until_us="long")


class LateSplit:
    """Rows that came in time and rows that came late, with the high-water mark after every batch.

    Inside a micro-batch rows go by ``arrival``; the mark of the batch before is where it starts from. A
    retried batch starts from the same mark and replaces what it wrote, the mark last.
    """

    def __init__(self, spark: SparkSession, root: str, window_seconds: int = DEFAULT_WINDOW_SECONDS,
                 lateness_windows: int = LATENESS_WINDOWS, arrival: str = "arrival"):
        self.spark, self.root, self.arrival = spark, root, arrival
        self.window_seconds, self.lateness_windows = window_seconds, lateness_windows

    def mark(self, batch_id: int) -> int | None:
        """The largest event time up to the end of a batch, in microseconds."""
        if batch_id < 0:
            return None
        return self.spark.read.schema(MARK).parquet(f"{self.root}/marks/batch_id={batch_id}").first()[0]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        before = self.mark(batch_id - 1)
        audited = late_audit(batch, self.window_seconds, self.lateness_windows, self.arrival, seen_before_us=before).persist()
        try:
            reason = F.when(F.col("is_late"), F.lit(LATE_REASON))
            audited.withColumn("reason", reason).write.mode("overwrite").partitionBy("is_late").parquet(
                f"{self.root}/rows/batch_id={batch_id}")
            newest = audited.agg(F.greatest(F.max(F.unix_micros("ts")), F.lit(before).cast("long")).alias("seen_until_us"))
            newest.write.mode("overwrite").parquet(f"{self.root}/marks/batch_id={batch_id}")
        finally:
            audited.unpersist()

    def rows(self, late: bool | None = None) -> DataFrame:
        """All stored rows, or only the late ones, or only those in time."""
        rows = self.spark.read.option("basePath", f"{self.root}/rows").parquet(f"{self.root}/rows").withColumn(
            "is_late", F.col("is_late").cast("boolean"))
        return rows if late is None else rows.where(F.col("is_late") == F.lit(late))

    def follow(self, events: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        return each_batch(events, self.write, checkpoint, "append", every)
