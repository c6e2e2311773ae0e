import zlib
from collections import Counter

from cases import SF, odd_texts, same_bag
from pyspark.sql import functions as F

from eventlake.llm import sharding
from eventlake.llm.queries import QUERIES


def check(rows, shards):
    """Counts at most one apart, slots gapless from 0."""
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(sizes) - min(sizes) <= 1


def test_query(spark, given_docs):
    rows = QUERIES["op3_shuffled_shards"](spark, SF).collect()
    check(rows, 8)
    same_bag([(r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows],
             [(d["doc_id"], len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode()), "rows", None) for d in given_docs])


def test_odd_rows_in_many_buckets(spark, odd_docs, no_docs):
    done = sharding.shuffle(odd_docs, 5, bucket_bytes=300)
    rows = done.collect()
    check(rows, 5)
    same_bag([(r["doc_id"], r["text"], r["lang"], r["Score"]) for r in rows],
             [(r["doc_id"], r["text"], r["lang"], r["Score"]) for r in odd_docs.collect()])
    assert len(rows) == len(odd_texts()) and sharding.shuffle(no_docs, 5).count() == 0


def test_order_depends_on_seed_and_rows_only(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    place = lambda df: {(r["doc_id"], r["shard"], r["slot"]) for r in df.collect()}
    one = place(sharding.shuffle(docs, 4, bucket_bytes=20_000))
    assert one == place(sharding.shuffle(docs.repartition(13, "text"), 4, bucket_bytes=20_000))
    assert one != place(sharding.shuffle(docs, 4, seed=1, bucket_bytes=20_000))
    next_to = sorted(one, key=lambda r: (r[1], r[2]))
    close = sum(abs(a[0] - b[0]) < 30 for a, b in zip(next_to, next_to[1:]))
    assert close < 3000 * 0.05  # about 2 % by chance


def test_equal_rows_beyond_a_bucket_are_split(spark):
    docs = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same row " * 20).alias("text"), F.col("id").alias("n"))
    rows = sharding.shuffle(docs, 8, bucket_bytes=50_000).collect()
    check(rows, 8)
    assert Counter(r["n"] for r in rows) == Counter(range(4000))


def test_written_shards_read_back(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string")
    sharding.write_shards(sharding.shuffle(docs, 3), str(tmp_path / "shards"))
    check(spark.read.parquet(str(tmp_path / "shards")).collect(), 3)
