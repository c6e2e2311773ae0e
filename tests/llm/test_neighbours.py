import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from cases import SF, odd_texts

from eventlake.llm import neighbours
from eventlake.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    found = {r["doc_id"]: r for r in QUERIES["op1_quality_neighbours"](spark, LARGER).collect()}
    labels = pq.read_table(f"{LARGER}/labels.parquet").to_pylist()
    assert len(found) == pq.read_metadata(f"{LARGER}/documents.parquet").num_rows
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    held = [(r["quality"], found[r["doc_id"]]["predicted"]) for r in labels if found[r["doc_id"]]["held_out"]]
    for quality in (0, 1):
        of = [q == p for q, p in held if q == quality]
        assert len(of) > 50 and np.mean(of) > 0.97


def test_scores_are_exact_votes(spark, given_docs):
    """The blocked products against one cosine at a time."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = neighbours.fit(docs, labels, max_per_class=20)
    assert len(model.vectors) <= 40
    found = {r["doc_id"]: r["score"] for r in neighbours.classify(docs, model).collect()}
    for d in given_docs[:60]:
        counts = neighbours.term_counts(d["text"])
        vector = np.sqrt(counts / max(counts[:neighbours.PAIR_TERMS].sum(), 1)) * model.idf
        point = (vector / np.linalg.norm(vector)) @ model.axes
        cosines = model.vectors @ (point / np.linalg.norm(point))
        near = np.argsort(-cosines)[:neighbours.NEIGHBOURS]
        weight = np.maximum(cosines[near], 0) ** neighbours.SHARPNESS * model.votes[near]
        assert found[d["doc_id"]] == pytest.approx((weight * model.labels[near]).sum() / weight.sum(), abs=1e-3)


def test_odd_texts_labels_and_empty_tables(spark, odd_docs, no_docs):
    schema = "doc_id long, quality int"
    labels = spark.createDataFrame([(4, 1), (4, 1), (40, 1), (41, 0), (42, 1), (42, 0), (43, None), (None, 1), (999, 0), (44, 7), (45, 0),
                                    (46, 1), (47, 0)], schema)
    model = neighbours.fit(odd_docs, labels)
    rows = neighbours.classify(odd_docs, model).collect()
    assert len(rows) == len(odd_texts()) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)} == {model.prior}
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    none = neighbours.fit(odd_docs, spark.createDataFrame([], schema))
    assert {r["score"] for r in neighbours.classify(odd_docs, none).collect()} == {0.5}
    assert neighbours.classify(no_docs, model).count() == 0
