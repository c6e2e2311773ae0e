"""Quality classifier: neighbours in a latent space vote with their labels.

Terms are hashed byte pairs of the whole text plus three counts of its shape (words that repeat the
word before, capitals, symbols). Term shares are weighted by inverse document frequency and reduced
by a truncated singular value decomposition. Labelled vectors are few by construction and broadcast;
every document is compared with all of them exactly, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlake.llm.common import beside, prepare_python

PAIR_TERMS, SHAPE_TERMS = 1024, 3
SYMBOLS = b"#*$%&|<>!"
CHUNK = 1 << 20
MAX_PER_CLASS = 2000   # labelled rows per class that the model is fitted on
DIMENSIONS = 32
NEIGHBOURS = 9
SHARPNESS = 8          # a neighbour's vote is its cosine to this power
BLOCK = 512


def _pair_table() -> np.ndarray:
    codes = np.arange(1 << 16, dtype=np.uint64)
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)).astype(np.int32)


_KIND = np.zeros(256, np.int64)
_KIND[65:91] = 1
_KIND[list(SYMBOLS)] = 2
_PAIRS = _pair_table()


def term_counts(text: str | None) -> np.ndarray:
    """Counts of hashed byte pairs, then the three shape counts; a wordless text has none."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    out = np.zeros(PAIR_TERMS + SHAPE_TERMS, np.float64)
    if not words:
        return out
    codes = np.frombuffer(b" " + data, np.uint8)
    kinds = np.zeros(3, np.int64)
    for at in range(0, len(data), CHUNK):  # bounded extra memory for very long texts
        part = codes[at:at + CHUNK + 1].astype(np.int32)
        out[:PAIR_TERMS] += np.bincount(_PAIRS[part[:-1] * 256 + part[1:]], minlength=PAIR_TERMS)
        kinds += np.bincount(_KIND[part[1:]], minlength=3)
    out[PAIR_TERMS] = sum(map(eq, words, words[1:])) * len(data) / len(words)
    out[PAIR_TERMS + 1:] = kinds[1], 3 * kinds[2]
    return out


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    shares = counts / np.maximum(counts[:, :PAIR_TERMS].sum(1, keepdims=True), 1)
    return _unit(np.sqrt(shares).astype(np.float32) * idf)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    """At most 2 * MAX_PER_CLASS vectors of DIMENSIONS numbers, and the projection into their space."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    prior: float

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of the neighbours' vote for label 1; the prior where no neighbour has a vote."""
        out = np.full(len(counts), self.prior)
        k = min(NEIGHBOURS, len(self.vectors))
        for at in range(0, len(counts) if k else 0, BLOCK):
            block = _unit(_weighted(counts[at:at + BLOCK], self.idf) @ self.axes)
            cosines = block @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64) ** SHARPNESS
            weight *= self.votes[near]
            total = weight.sum(1)
            voted = total > 1e-12
            share = (weight * self.labels[near]).sum(1) / np.maximum(total, 1e-12)
            out[at:at + BLOCK][voted] = np.clip(share, 0, 1)[voted]
        return out


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 3, is 1 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> Model:
    """The model of the labelled rows that are not held out.

    Of each class the ``max_per_class`` documents with the least id hash are used. A document with
    contradicting labels, or ids without a document, are left out. Several texts of one id count as
    the alphabetically first. Without labelled rows every score is 0.5.
    """
    prepare_python(docs.sparkSession)
    marked = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("label"))
              .where((F.col("low") == F.col("label")) & ~held_out(F.col("doc_id"))))
    marked = marked.join(docs.select("doc_id"), "doc_id", "left_semi")
    by_class = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    # a hash limit leaves few more ids than are taken, so that ranking them is no work, however many there are
    limit = F.lit(None).cast("long")
    for label, count in by_class.items():
        share = min(1.0, (max_per_class + 8 * max_per_class ** 0.5 + 64) / count)
        limit = F.when(F.col("label") == label, F.lit(min((1 << 63) - 1, int((2 * share - 1) * (1 << 63))))).otherwise(limit)
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = (marked.where(F.xxhash64("doc_id") <= limit).withColumn("place", F.row_number().over(order))
              .where(F.col("place") <= max_per_class).select("doc_id", "label"))
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
             .groupBy("doc_id", "label").agg(F.min("text").alias("text")))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "terms": [
                term_counts(t).astype("<f4").tobytes() for t in batch["text"]]})

    rows = texts.mapInPandas(count, "doc_id long, label int, terms binary").collect()
    rows.sort(key=lambda r: r["doc_id"])
    if not rows:
        zero = np.zeros((0, DIMENSIONS), np.float32)
        return Model(np.ones(PAIR_TERMS + SHAPE_TERMS, np.float32),
                     np.zeros((PAIR_TERMS + SHAPE_TERMS, DIMENSIONS), np.float32), zero, zero[:, 0], zero[:, 0], 0.5)
    counts = np.stack([np.frombuffer(r["terms"], "<f4") for r in rows])
    truth = np.array([r["label"] for r in rows], np.float64)
    idf = (np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
    weighted = _weighted(counts, idf)
    axes = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))[1][:, ::-1][:, :DIMENSIONS].astype(np.float32)
    # classes are sampled evenly; votes lean half way back to the shares they have in the labels
    used = {c: max(1, int((truth == c).sum())) for c in by_class}
    lean = {c: np.sqrt(n / used[c]) for c, n in by_class.items()}
    prior = by_class.get(1, 0) / sum(by_class.values())
    return Model(idf, axes, _unit(weighted @ axes), truth, np.array([lean[int(c)] for c in truth]), prior)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    Null and wordless texts have no terms and get the prior. Repeated rows get equal scores. An empty
    table gives an empty result. Columns of these names give way to the results.
    """
    prepare_python(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [sent.value.scores(np.stack([term_counts(t) for t in texts.iloc[at:at + BLOCK]]))
                     for at in range(0, len(texts), BLOCK)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    scored = beside(docs, F.struct(held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")),
                    ["held_out", "score"])
    return beside(scored, F.struct((F.col("score") >= 0.5).cast("int").alias("predicted")), ["predicted"])
