"""SimHash near-dedup: fingerprints of word shingles, linked when a few bits differ.

A Gray-order hierarchical index finds the links. Fingerprints are sorted by Gray rank, so neighbours
share bits; runs of neighbours form nodes that keep the bits all their members share. A child keeps
only the shared bits its parent does not have, so the differences between a query and a group add up
on the way down, and a group is left as soon as they exceed the limit.

At most ``d`` differing bits leave at least one of ``d + 1`` equal slices of a fingerprint untouched.
Each slice is rotated to the front once, where it is the pattern of the index's uppermost nodes: a
query enters only the node with the same slice. That node is also the unit of distribution.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from eventlake.llm.common import fresh, on_texts, prepare_python, stored

SHINGLE_WORDS, MAX_BITS, SEED = 3, 3, 42
FANOUT = 16
CELL_ROWS = 1 << 20       # fingerprints under one uppermost node that one task takes
FLUSH_ROWS = 1 << 17      # small nodes are searched together
FRONTIER = 1 << 20        # (query, node) pairs held at once
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words_each: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text: bit set where over half of its shingle hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_each:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = (starts + lengths)[words_each - 1:].tolist()
    starts = starts[:len(ends)].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(ends), HASHES_AT_ONCE):
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in
                           zip(starts[at:at + HASHES_AT_ONCE], ends[at:at + HASHES_AT_ONCE])],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int((np.uint64(1) << np.arange(64, dtype=np.uint64))[2 * ones > len(ends)].sum(dtype=np.uint64))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint_column(text: Column, words_each: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a long with the same 64 bits."""
    made = on_texts(lambda texts: [(_signed(fingerprint(t, words_each)),) for t in texts], "f long")
    return made(text)["f"]


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each code word in the Gray sequence."""
    ranks = values.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        ranks = ranks ^ (ranks >> np.uint64(shift))
    return ranks


class GrayIndex:
    """Nodes over Gray-ordered codes, level 0 being the codes themselves."""

    def __init__(self, codes: np.ndarray, fanout: int = FANOUT):
        self.codes, self.fanout = codes, fanout
        shared_ones, ones = [codes], [codes]
        while len(ones[-1]) > 1:
            at = np.arange(0, len(ones[-1]), fanout)
            shared_ones.append(np.bitwise_and.reduceat(shared_ones[-1], at))
            ones.append(np.bitwise_or.reduceat(ones[-1], at))
        self.bits = shared_ones
        masks = [~(a ^ o) for a, o in zip(shared_ones, ones)]
        up = [masks[k + 1][np.arange(len(m)) // fanout] for k, m in enumerate(masks[:-1])]
        self.own = [m & ~u for m, u in zip(masks, up)] + [masks[-1]]
        self.masks = masks

    def levels_for(self, spans: np.ndarray) -> np.ndarray:
        """The lowest level at which a span of codes touches at most two nodes."""
        level, width = np.zeros(len(spans), np.int64), 1
        while width < (spans.max() if len(spans) else 0) and level.max() < len(self.bits) - 1:
            level[spans > width] += 1
            width *= self.fanout
        return level


class Forest:
    """Disjoint sets over positions, merged many pairs at a time; a set's root is its least member."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def merge(self, left: np.ndarray, right: np.ndarray) -> None:
        while len(left):
            a, b = self.root[left], self.root[right]
            apart = a != b
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            if not len(left):
                return
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def linked_codes(codes: np.ndarray, cells: np.ndarray, max_bits: int) -> Forest:
    """Sets of codes connected by at most ``max_bits`` differing bits within a cell.

    ``codes`` must be ordered by (cell, Gray rank). Nodes whose members already are in the query's
    set are skipped, so a dense group costs about its size and not its square.
    """
    n, forest = len(codes), Forest(len(codes))
    if n < 2:
        return forest
    index = GrayIndex(codes)
    for step in range(1, min(4, n)):  # neighbours in the order are likely links: merge them first
        near = np.arange(n - step)
        close = np.bitwise_count(codes[near] ^ codes[near + step]) <= max_bits
        forest.merge(near[close], near[close] + step)
    first = np.searchsorted(cells, cells, "left")
    last = np.searchsorted(cells, cells, "right")
    level = index.levels_for(last - first)
    uniform = _uniform(forest.root, index)
    for top in np.unique(level):
        queries = np.flatnonzero(level == top)
        width = index.fanout ** int(top)
        spans = (last - first)[queries]
        ends = np.concatenate([[0], np.cumsum(spans)])
        at = 0
        while at < len(queries):
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + FRONTIER, "right")) - 1)
            block = queries[at:upto]
            at = upto
            # pairs are looked up once: from a code to those behind it in its cell
            start, stop = block // width, (last[block] - 1) // width
            count = stop - start + 1
            query = np.repeat(block, count)
            node = np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            if top:  # level 0 nodes are codes, compared below
                differing = np.bitwise_count((codes[query] ^ index.bits[top][node]) & index.masks[top][node])
            else:
                differing = np.bitwise_count(codes[query] ^ codes[node])
            k = int(top)
            while True:
                keep = (differing <= max_bits) & (uniform[k][node] != forest.root[query])
                query, node, differing = query[keep], node[keep], differing[keep]
                if not k or not len(query):
                    break
                k -= 1
                children = node[:, None] * index.fanout + np.arange(index.fanout)
                query = np.repeat(query, index.fanout)
                differing = np.repeat(differing, index.fanout)
                node = children.ravel()
                there = (node < len(index.bits[k])) & ((node + 1) * index.fanout ** k > query)
                query, node, differing = query[there], node[there], differing[there]
                differing = differing + np.bitwise_count((codes[query] ^ index.bits[k][node]) & index.own[k][node])
            if len(query):
                forest.merge(query, node)
                uniform = _uniform(forest.root, index)
    return forest


def _uniform(roots: np.ndarray, index: GrayIndex) -> list[np.ndarray]:
    """For each node the one set that all its members are in, or -1."""
    low, high, out = roots, roots, [np.full(len(roots), -1)]
    out[0] = roots
    for _ in index.bits[1:]:
        at = np.arange(0, len(low), index.fanout)
        low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        out.append(np.where(low == high, low, -1))
    return out


def _search(max_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0

        def links(part: pd.DataFrame) -> pd.DataFrame:
            cells, codes = part["cell"].to_numpy(), part["code"].to_numpy().view(np.uint64)
            order = np.lexsort((gray_rank(codes), cells))
            cells, codes, prints = cells[order], codes[order], part["print"].to_numpy()[order]
            root = linked_codes(codes, cells, max_bits).root
            off = root != np.arange(len(root))
            a, b = prints[off], prints[root[off]]
            return pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})

        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows < FLUSH_ROWS:
                continue
            whole = pd.concat(held, ignore_index=True)
            cut = int(np.searchsorted(whole["cell"].to_numpy(), whole["cell"].iloc[-1], "left"))
            held, rows = [whole.iloc[cut:]], len(whole) - cut
            if cut:
                yield links(whole.iloc[:cut])
        if rows:
            yield links(pd.concat(held, ignore_index=True))

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (a > b) that connect all distinct values of ``print`` linked by ``max_bits`` or fewer.

    Only edges of a spanning forest of every cell are returned, at most one per value and slice. A
    slice value with more than ``cell_rows`` members is cut into hashed chunks, and each pair of
    chunks becomes a cell, so no task takes more than two chunks and no pair is lost.
    """
    width = 64 // (max_bits + 1)
    turned = [F.struct(F.lit(r).cast("long").alias("turn"),
                       (F.shiftleft("print", r * width).bitwiseOR(
                           F.shiftrightunsigned("print", 64 - r * width)) if r else F.col("print")).alias("code"))
              for r in range(max_bits + 1)]
    turns = prints.select("print", F.explode(F.array(*turned)).alias("t")).select(
        "print", "t.code",
        (F.col("t.turn") * (1 << width) + F.shiftrightunsigned("t.code", 64 - width)).alias("slice"))
    heavy = turns.groupBy("slice").count().where(F.col("count") > cell_rows).select(
        "slice", F.ceil(F.col("count") / cell_rows).alias("chunks"))
    # at most (max_bits + 1) * 2 ** width slices exist, whatever the number of documents
    placed = turns.join(F.broadcast(heavy), "slice", "left")
    chunk = F.pmod(F.xxhash64("print"), F.col("chunks"))
    pairs = F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda other: F.least(chunk, other) * 32768 + F.greatest(chunk, other)))
    cells = placed.select("print", "code", "slice", F.explode(pairs).alias("pair")).select(
        "print", "code", F.shiftleft("slice", 31).bitwiseOR(F.col("pair")).alias("cell"))
    cells = cells.repartition("cell").sortWithinPartitions("cell")
    return cells.mapInPandas(_search(max_bits), "a long, b long").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a > b), root being the least node it reaches.

    Alternates two contractions: a node's larger neighbours move to its least neighbour, then its
    smaller ones do. Each step is a grouped minimum and a join, checkpointed, until nothing moves.
    """
    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stored(edges)
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")))
        large = stored(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())
        least = stored(large.groupBy("a").agg(F.min("b").alias("least")))
        small = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = stored(small.union(least.select("a", F.col("least").alias("b"))).distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """(doc_id, row_key, print, component_id), one row per document.

    Null and wordless texts have fingerprint 0 and are linked like any other. Repeated rows stay
    repeated. A null doc_id gets the component of its fingerprint; it is never the least id, so
    component_id is null only where no document of the component has an id. Other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """
    prepare_python(docs.sparkSession)
    rows = stored(docs.select("doc_id", row_key().alias("row_key"),
                              fingerprint_column(F.col("text"), words_each).alias("print")))
    prints = stored(rows.groupBy("print").agg(F.min("doc_id").alias("first_id")))
    roots = connected(links(prints.select("print"), max_bits, cell_rows))
    tied = prints.join(roots, F.col("print") == F.col("node")).select("print", "root", "first_id")
    ends = prints.join(roots.select("root").distinct(), F.col("print") == F.col("root")).select(
        "print", "root", "first_id")
    tied = stored(tied.union(ends))
    of_root = tied.groupBy("root").agg(F.min("first_id").alias("component_id"))
    moved = tied.join(of_root, "root").select("print", "component_id")
    classes = stored(prints.join(moved, "print", "left").select(
        "print", F.coalesce("component_id", "first_id").alias("component_id")))
    return rows.join(classes, "print").select("doc_id", "row_key", "print", "component_id")


def row_key() -> Column:
    """A digest of doc_id and text; never null, so that grouping and joining by it share one shuffle."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one row of every component: the one with the least doc_id.

    Among rows with that doc_id (or without any id) the one with the least digest of id and text
    stays, once. Columns are those of ``docs``.
    """
    found = near_duplicates(docs, **how)
    best = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("print")).alias("at")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("best"))
    key = fresh(docs, "row_key")
    chosen = best.select(F.col("best.row_key").alias(key))
    return docs.withColumn(key, row_key()).dropDuplicates([key]).join(chosen, key, "left_semi").drop(key)
