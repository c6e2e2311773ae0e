"""Shuffled shards in two passes.

Pass one scatters records by seeded hash into buckets that fit in memory. Pass two shuffles each
bucket by Fisher and Yates and lays the buckets end to end; shards are equal stretches of that line.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from eventlake.llm.common import prepare_python, quoted, stored
from eventlake.operators.joins import checked_broadcast

BUCKET_BYTES = 16 << 20
ROW_BYTES = 64               # counted for a record besides its text
SEED = 20240229


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus one; one for null."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _shuffled(seed: int, shards: int, rows: int, names: list[str]):
    def run(key: tuple[pa.Scalar, ...], bucket: pa.Table, offset: pa.Table) -> pa.Table:
        order = np.argsort(bucket["hash_"].to_numpy(), kind="stable")  # whatever order the rows came in
        rng = np.random.default_rng([seed, key[0].as_py()])
        partners = rng.integers(0, np.arange(1, len(order) + 1))
        for i in range(len(order) - 1, 0, -1):
            j = partners[i]
            order[i], order[j] = order[j], order[i]
        line = offset["offset_"][0].as_py() + np.arange(len(order), dtype=np.int64)
        shard = line * shards // rows
        first = -(-shard * rows // shards)
        return bucket.select(names).take(pa.array(order)).append_column("shard", pa.array(shard)).append_column(
            "slot", pa.array(line - first))

    return run


def shuffle(docs: DataFrame, shards: int, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    The law is ``rows``: shards differ by one row at most. The order depends on the seed and on the
    rows' doc_id and text, not on how the input is split. Where rows equal in both would overfill a
    bucket, they are scattered by their place in the input, and the scattered rows are stored once.
    Null ids and texts are values like others; an empty table gives an empty result; columns named
    ``shard`` or ``slot`` give way.
    """
    prepare_python(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    names = [f"c{i}" for i in range(len(kept))]
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    keyed = docs.select(*[quoted(c).alias(n) for c, n in zip(kept, names)],
                        F.xxhash64(F.lit(seed), quoted("doc_id"), F.coalesce(quoted("text"), F.lit(""))).alias("hash_"),
                        (record_size(quoted("text")) + ROW_BYTES).alias("bytes_"))
    per_hash = stored(keyed.groupBy("hash_").agg(F.count("*").alias("n"), F.sum("bytes_").alias("bytes_")))
    rows, size = per_hash.agg(F.sum("n"), F.sum("bytes_")).first()
    buckets = max(1, math.ceil((size or 0) / bucket_bytes))
    # hashes that fill a quarter of a bucket: at most four times as many as there are buckets
    crowded = per_hash.where(F.col("bytes_") > bucket_bytes / 4).select("hash_", F.lit(True).alias("crowded_"))
    place = F.xxhash64(F.lit(seed), "hash_")
    scattered = keyed
    any_crowded = bool(crowded.head(1))
    if any_crowded:
        scattered = keyed.join(checked_broadcast(crowded), "hash_", "left")
        place = F.when(F.col("crowded_"), F.xxhash64(F.lit(seed), "hash_", F.monotonically_increasing_id())).otherwise(place)
    scattered = scattered.select("hash_", *names, F.pmod(place, F.lit(buckets)).alias("bucket_"))
    if any_crowded:
        scattered = stored(scattered)
    line = Window.orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    offsets = scattered.groupBy("bucket_").count().select(
        "bucket_", F.coalesce(F.sum("count").over(line), F.lit(0)).alias("offset_"))
    schema = T.StructType([*[T.StructField(n, kinds[c]) for c, n in zip(kept, names)],
                           T.StructField("shard", T.LongType()), T.StructField("slot", T.LongType())])
    done = scattered.groupBy("bucket_").cogroup(offsets.groupBy("bucket_")).applyInArrow(
        _shuffled(seed, shards, rows or 0, names), schema)
    return done.select(*[F.col(n).alias(c) for c, n in zip(kept, names)], F.col("shard").cast("int").alias("shard"), "slot")


def write_shards(shuffled: DataFrame, folder: str) -> None:
    """One folder per shard; its files hold stretches of slots in order."""
    shuffled.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(folder)
