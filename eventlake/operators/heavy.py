"""Ordered work on keys of any size.

A window partitioned by a key runs in one task per key, which fails when one key owns a large share
of the rows. Keys with more than ``heavy_rows`` rows therefore take another road: their rows are cut
into ordered chunks of about equal size, every chunk is worked on by itself, and a small table of chunk
totals carries the running state from chunk to chunk. Both roads give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from eventlake.operators.joins import checked_broadcast
from eventlake.session import stored

# Rows one task may hold for one key. It also bounds the broadcast list of heavy keys: a table of N
# rows has fewer than N / HEAVY_ROWS of them.
HEAVY_ROWS = 1_000_000


def heavy_keys(df: DataFrame, keys: Sequence[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Keys with more than ``heavy_rows`` rows (an exact count, so every use sees the same list)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    return counts.where(F.col("key_rows") > F.lit(heavy_rows)).select(*keys)


def split_heavy(df: DataFrame, keys: Sequence[str], light: Callable[[DataFrame], DataFrame],
                heavy: Callable[[DataFrame], DataFrame], heavy_rows: int = HEAVY_ROWS,
                counted: DataFrame | None = None) -> DataFrame:
    """``light`` over the rows of ordinary keys, ``heavy`` over the rest, put together.

    Looks for heavy keys right away, with one job that reads only the key columns. Usually there is
    none, and the plan is the plain one with a single shuffle. ``counted`` are the rows to count when
    ``df`` is costlier to read than they are.
    """
    listed = heavy_keys(df if counted is None else counted, keys, heavy_rows)
    if listed.isEmpty():
        return light(df)
    listed = checked_broadcast(listed)
    return light(df.join(listed, list(keys), "left_anti")).unionByName(
        heavy(df.join(listed, list(keys), "left_semi")))


def in_chunks(df: DataFrame, order: Sequence[str], name: str = "chunk",
              heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``df`` with the number of its chunk: stretches of about ``heavy_rows`` rows in ``order``.

    Chunks are the ranges of a range partitioning, so they follow the rank of the rows and not the
    values, however sparse those are. Rows are stored once with their numbers, because ranges are
    sampled and every use has to see the same.
    """
    chunks = max(1, math.ceil(df.count() / heavy_rows))
    return stored(df.repartitionByRange(chunks, *order).withColumn(name, F.spark_partition_id().cast("long")))


def before_chunk(keys: Sequence[str], chunk: Sequence[str]):
    """All chunks of the same key before the current one."""
    return Window.partitionBy(*keys).orderBy(*chunk).rowsBetween(
        Window.unboundedPreceding, -1)


def forward_fill(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str],
                 heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Replace each column by its latest non-null value so far, per key in ``order``."""

    def fill(part: DataFrame, partition: Sequence[str]) -> DataFrame:
        so_far = Window.partitionBy(*partition).orderBy(order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        return part.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns})

    def chunked(part: DataFrame) -> DataFrame:
        part = in_chunks(part, [*keys, order], heavy_rows=heavy_rows)
        totals = part.groupBy(*keys, "chunk").agg(*[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])
        earlier = before_chunk(keys, ["chunk"])
        carry = totals.select(*keys, "chunk", *[
            F.last(c, ignorenulls=True).over(earlier).alias(f"carry_{c}") for c in columns])
        filled = fill(part, [*keys, "chunk"]).join(carry, [*keys, "chunk"])
        return filled.withColumns(
            {c: F.coalesce(F.col(c), F.col(f"carry_{c}")) for c in columns}
        ).drop("chunk", *[f"carry_{c}" for c in columns])

    return split_heavy(df, keys, lambda part: fill(part, keys), chunked, heavy_rows)


def running_max(df: DataFrame, order: str, value: str, name: str,
                heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Largest ``value`` on all rows before this one, over a whole log in ``order``.

    The log is one single group, so it is always cut into chunks; only one row per chunk meets in
    the window that has no partition key.
    """
    chunked = in_chunks(df, [order], heavy_rows=heavy_rows)
    totals = chunked.groupBy("chunk").agg(F.max(value).alias("chunk_max"))
    carry = totals.select(
        "chunk", F.max("chunk_max").over(before_chunk([], ["chunk"])).alias("carry_max"))
    inside = Window.partitionBy("chunk").orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)
    return chunked.withColumn(name, F.max(value).over(inside)).join(carry, "chunk").withColumn(
        name, F.greatest(F.col(name), F.col("carry_max"))).drop("chunk", "carry_max")


def first_per_key(df: DataFrame, key: str, order: str, limit: int, lanes: int = 64) -> DataFrame:
    """The ``limit`` lowest rows per key in a unique integer ``order``.

    Each key is first cut down inside ``lanes`` salted groups, so no task sorts a whole key.
    """
    lane = F.pmod(F.xxhash64(order), F.lit(lanes))
    salted = Window.partitionBy(key, "lane").orderBy(order)
    whole = Window.partitionBy(key).orderBy(order)
    return (
        df.withColumn("lane", lane)
        .withColumn("place", F.row_number().over(salted)).where(F.col("place") <= limit)
        .withColumn("place", F.row_number().over(whole)).where(F.col("place") <= limit)
        .drop("lane", "place")
    )
