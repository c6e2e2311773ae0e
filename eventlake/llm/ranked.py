"""Ranked lexical search turned round: documents stream through an inverted index of the queries.

The index over the items' terms is broadcast. Every task counts the terms of its documents, adds up the
scores of the items a document's terms lead to, and keeps one bounded heap per item. The heaps of all
tasks are merged in two steps.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from eventlake.llm.common import alnum_words, prepare_python, stored, text_key

TOP = 10
BLOCK_POSTINGS = 1 << 20  # (text, term) pairs of one broadcast index
CELLS = 1 << 22           # scores or postings held at once in a task
MERGE_WAYS = 64
NO_ID = 1 << 63           # sorts a null doc_id behind every other
DOCUMENTS, TERMS = -1, -2  # figures counted beside the terms' document counts

_KEPT = [c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)]
_TABLE = bytes(_KEPT)


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of 0-9, A-Z, a-z and all beyond ASCII, with A-Z in small letters."""
    return (text or b"").translate(_TABLE).split()


@dataclass
class Index:
    """Postings of one block of queries: term number to (query number, occurrences in the query)."""

    keys: list[str]
    numbers: dict[bytes, int]
    starts: np.ndarray
    queries: np.ndarray
    times: np.ndarray


def build_index(rows: pa.Table) -> Index:
    """From (text_key, term, times) rows, at most about ``BLOCK_POSTINGS`` of them."""
    names, terms = rows["text_key"].to_pylist(), [t.encode() for t in rows["term"].to_pylist()]
    keys, distinct = sorted(set(names)), sorted(set(terms))
    place, numbers = {k: i for i, k in enumerate(keys)}, {t: i for i, t in enumerate(distinct)}
    of_term = np.fromiter((numbers[t] for t in terms), np.int64, len(terms))
    order = np.argsort(of_term, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(of_term, minlength=len(distinct)))]).astype(np.int64)
    queries = np.fromiter((place[k] for k in names), np.int64, len(names))[order]
    return Index(keys, numbers, starts, queries, np.asarray(rows["times"].to_numpy(), np.int64)[order])


def _counts(numbers: dict[bytes, int], texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms in each text, and per (text, known term): text number, term number, occurrences."""
    lengths, found = [], []
    for text in texts:
        words = terms_of(text)
        lengths.append(len(words))
        found.append(np.fromiter(map(numbers.get, words, repeat(-1)), np.int64, len(words)))
    whole = np.concatenate(found) if found else np.zeros(0, np.int64)
    where = np.repeat(np.arange(len(texts)), lengths)[whole >= 0]
    pairs, times = np.unique(where * len(numbers) + whole[whole >= 0], return_counts=True)
    return np.array(lengths, np.int64), pairs // len(numbers), pairs % len(numbers), times.astype(np.int64)


def _figures(held: Broadcast):
    """Per task: documents with a term, terms in all, and documents holding each known term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = held.value.numbers
        documents, terms, holding = 0, 0, np.zeros(len(numbers), np.int64)
        for batch in batches:
            lengths, _, of_term, _ = _counts(numbers, batch.column("text").to_pylist())
            documents, terms = documents + int((lengths > 0).sum()), terms + int(lengths.sum())
            holding += np.bincount(of_term, minlength=len(numbers))
        known = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array([DOCUMENTS, TERMS, *known.tolist()], pa.int64()),
             pa.array([documents, terms, *holding[known].tolist()], pa.int64())], ["term", "n"])

    return run


@dataclass
class Weighted:
    """An index with what the corpus says: term weights, documents and terms in all."""

    index: Index
    weights: np.ndarray
    documents: int
    terms: int


def _scores(held: Weighted, lengths: np.ndarray, where: np.ndarray, of_term: np.ndarray, times: np.ndarray,
            first: int, last: int) -> np.ndarray:
    """Exact scores of the texts ``first`` to ``last`` for every query."""
    index = held.index
    scores = np.zeros((last - first) * len(index.keys), np.int64)
    low, high = np.searchsorted(where, [first, last])
    where, of_term, times = where[low:high], of_term[low:high], times[low:high]
    spread = 25 + (75 * lengths[where] * held.documents) // held.terms
    part = held.weights[of_term] * ((1_000_000_000 * times) // (1000 * times + 8 * spread))
    reach = index.starts[of_term + 1] - index.starts[of_term]
    ends = np.cumsum(reach)
    at = 0
    while at < len(reach):  # postings of some terms at a time
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS)))
        n = reach[at:upto]
        posting = np.arange(int(n.sum())) + np.repeat(index.starts[of_term[at:upto]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        cell = np.repeat(where[at:upto] - first, n) * len(index.keys) + index.queries[posting]
        np.add.at(scores, cell, np.repeat(part[at:upto], n) * index.times[posting])
        at = upto
    return scores.reshape(last - first, len(index.keys))


def _search(held: Broadcast, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value: Weighted = held.value
        keys = value.index.keys
        heaps: list[list[tuple[int, int]]] = [[] for _ in keys]
        least = np.ones(len(keys), np.int64)
        step = max(1, CELLS // len(keys))
        for batch in batches:
            ids, counted = batch.column("doc_id").to_pylist(), _counts(value.index.numbers, batch.column("text").to_pylist())
            for first in range(0, len(ids), step):
                scores = _scores(value, *counted, first, min(first + step, len(ids)))
                for row, query in np.argwhere(scores >= least):
                    doc_id = ids[first + row]
                    entry, heap = (int(scores[row, query]), -(NO_ID if doc_id is None else doc_id)), heaps[query]
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == top:
                        least[query] = heap[0][0]
        rows = [(keys[q], None if d == -NO_ID else -d, s) for q, heap in enumerate(heaps) for s, d in heap]
        way = TaskContext.get().partitionId() % MERGE_WAYS
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([way] * len(rows), pa.int32())],
            ["text_key", "doc_id", "score", "way"])

    return run


def merged(heaps: DataFrame, top: int) -> DataFrame:
    """Heaps of all tasks, merged in some ways side by side and then into one per query."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    ranked = F.row_number().over(Window.partitionBy("text_key", "way").orderBy(*order))
    some = heaps.withColumn("rank", ranked).where(F.col("rank") <= top).drop("rank")
    ranked = F.row_number().over(Window.partitionBy("text_key").orderBy(*order))
    return some.drop("way").withColumn("rank", ranked).where(F.col("rank") <= top)


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The ``top`` documents of highest score for every item: (item_id, rank, doc_id, score).

    A term's weight is floor(1000 ln((2N+2)/(2df+1))); a document's score is the integer sum of
    weight * ((10^9 tf) div (1000 tf + 8m)) over the item's terms, repeats included, with
    m = 25 + (75 n N) div L. Only scores above 0 are ranked; equal scores go by ascending doc_id, a null
    doc_id last. Equal item texts are searched once, and each of their rows gets the result. Repeated
    document rows are documents of their own. Null and empty texts have no terms: such documents are not
    counted, such items find nothing. Other columns are not read.

    Queries beyond ``block_postings`` (text, term) pairs go in blocks of about that size, by a hash of their text; every
    block streams all documents twice, for the corpus figures and for the scores. A task holds one
    index and ``top`` entries per query of the block, whatever the number of documents.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    texts = items.select("text").distinct().select(text_key(F.col("text")).alias("text_key"), F.explode(alnum_words(F.col("text"))).alias("term"))
    postings = stored(texts.groupBy("text_key", "term").agg(F.count("*").alias("times")))
    blocks = math.ceil(postings.count() / block_postings)
    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    heaps = []
    for block in range(blocks):
        own = postings.where(F.pmod(F.xxhash64("text_key"), F.lit(blocks)) == block).toArrow()
        if not own.num_rows:
            continue
        index = build_index(own)
        seen = read.select("text").mapInArrow(_figures(spark.sparkContext.broadcast(index)), "term long, n long")
        figures = {r["term"]: r["n"] for r in seen.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        n = figures.get(DOCUMENTS, 0)
        if not n:
            break
        weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * figures.get(t, 0) + 1))) for t in range(len(index.numbers))]
        held = spark.sparkContext.broadcast(Weighted(index, np.array(weights, np.int64), n, figures[TERMS]))
        heaps.append(read.mapInArrow(_search(held, top), "text_key string, doc_id long, score long, way int"))
    if not heaps:
        return items.select("item_id").where(F.lit(False)).selectExpr(
            "item_id", "CAST(0 AS INT) AS rank", "CAST(0 AS BIGINT) AS doc_id", "CAST(0 AS BIGINT) AS score")
    found = merged(reduce(DataFrame.unionByName, heaps), top)
    return items.select("item_id", text_key(F.col("text")).alias("text_key")).join(found, "text_key").select(
        "item_id", "rank", "doc_id", "score")
