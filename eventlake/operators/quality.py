"""Schema drift and source-to-target reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventlake.session import stored

TREE_BITS, LEVEL_BITS = 16, 4


def payload_keys(payloads: DataFrame, payload: str, known: Sequence[str], order: str) -> DataFrame:
    """Every key seen in a JSON object column: how often, in which order range, and if it is new."""
    keys = F.explode(F.json_object_keys(payload)).alias("key")
    return payloads.select(keys, order).groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.min(order).alias("first_seen"),
        F.max(order).alias("last_seen")).withColumn("is_new", ~F.col("key").isin(*known))


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str],
              columns: Sequence[str]) -> DataFrame:
    """Row counts by outcome: match, mismatch, only in the source, only in the target.

    Both sides shrink to their key and a row hash before they meet, in one aggregation by key.
    """
    def hashed(rows: DataFrame, side: str) -> DataFrame:
        text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        return rows.select(*keys, F.sha2(text, 256).alias("row_hash"), F.lit(side).alias("side"))

    def held(side: str):
        return F.max(F.when(F.col("side") == side, F.col("row_hash"))).alias(side)

    compared = hashed(source, "source").unionByName(hashed(target, "target")) \
        .groupBy(*keys).agg(held("source"), held("target"))
    outcome = F.when(F.col("target").isNull(), "only_source") \
        .when(F.col("source").isNull(), "only_target") \
        .when(F.col("source") == F.col("target"), "match").otherwise("mismatch")
    return compared.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


# --- digest trees --------------------------------------------------------------------------------

def _leaf(keys: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def digests(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int = TREE_BITS) -> DataFrame:
    """(node, rows, one, two): order-free digests of the rows whose key hashes to each of ``2 ** bits`` leaves.

    A digest is two sums of row hashes, which are added up before the shuffle: what is shuffled and kept
    is bounded by the leaves, whatever the number of rows. Digests of the same rows are equal in any
    order and partitioning, so each side can make its own where its rows are.
    """
    text = F.to_json(F.struct(*keys, *columns), {"ignoreNullFields": "false"})
    hashed = rows.select(_leaf(keys, bits).alias("node"), F.xxhash64(text).alias("one"), F.xxhash64(text, F.lit(1)).alias("two"))
    sums = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("one", "two")]
    return hashed.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), *sums)


def unequal_leaves(source: DataFrame, target: DataFrame, bits: int = TREE_BITS, level_bits: int = LEVEL_BITS) -> DataFrame:
    """Leaves (node) whose digests differ, found level by level under unequal nodes only."""
    found, above = None, 0
    for depth in [*range(level_bits, bits, level_bits), bits]:
        sides = [_at_depth(side, bits, depth, found, above) for side in (source, target)]
        differ = sides[0].alias("s").join(sides[1].alias("t"), "node", "full").where(
            ~F.col("s.digest").eqNullSafe(F.col("t.digest")))
        found, above = stored(differ.select("node")), depth  # 2 ** depth rows at most
        if found.isEmpty():
            break
    return found


def _at_depth(side: DataFrame, bits: int, depth: int, unequal: DataFrame | None, above: int) -> DataFrame:
    """Digests of the nodes at ``depth``, below the ``unequal`` nodes at depth ``above``."""
    if unequal is not None:
        side = side.withColumn("parent", F.shiftright("node", bits - above)).join(
            F.broadcast(unequal.withColumnRenamed("node", "parent")), "parent", "left_semi")
    return side.groupBy(F.shiftright("node", bits - depth).alias("node")).agg(
        F.struct(F.sum("rows"), F.sum("one"), F.sum("two")).alias("digest"))


def reconcile_tree(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   bits: int = TREE_BITS) -> DataFrame:
    """Like ``reconcile``, but rows are shuffled only where the digests of both sides differ.

    Rows under equal leaves match; their number is known from the digests.
    """
    keys, columns = list(keys), list(columns)
    trees = [stored(digests(side, keys, columns, bits)) for side in (source, target)]
    leaves = unequal_leaves(*trees, bits)

    def under(side: DataFrame) -> DataFrame:
        return side.withColumn("node", _leaf(keys, bits)).join(F.broadcast(leaves), "node", "left_semi")

    equal = trees[0].join(F.broadcast(leaves), "node", "left_anti").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    found = reconcile(under(source), under(target), keys, columns).unionByName(
        equal.select(F.lit("match").alias("outcome"), "rows"))
    return found.groupBy("outcome").agg(F.sum("rows").alias("rows")).where(F.col("rows") > 0)
