"""Every stage of the pipeline against brute force on its own input."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from cases import SF, same_bag
from test_packing import check, digest, ids_of, tokenizer  # noqa: F401
from test_secret_scan import base
from test_simhash import classes, plain_print
from test_winnowing import brute

import corpus_pipeline
from eventlake.llm import neighbours, secret_scan

STAGES = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents plus copies, contaminated and secret ones, nulls, repeated rows and an extra column."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    first = given.orderBy("doc_id").first()["text"]
    more = [(900_001, first, "en", "s", len(first)), (900_002, first + " one more", "en", "s", 0), (900_003, items[0]["text"], "en", "s", 0),
            (900_004, "a clean text with password=abcdef0123456789 inside of it", "en", "s", 56), (900_005, None, None, None, None),
            (None, "a text without an id but with words", "en", "s", 0), (None, "a text without an id but with words", "en", "s", 0)]
    return given.union(spark.createDataFrame(more, given.schema)).selectExpr("*", "'x' AS found")


def test_stages_are_those_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "packing"]


def test_quality_classifier(spark, docs):
    kept = STAGES["quality classifier"](spark, docs, SF)
    assert kept.columns == docs.columns
    model = neighbours.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    counts = np.stack([neighbours.term_counts(t) for _, t in rows_of(docs)])
    good = model.scores(counts) >= 0.5
    same_bag(rows_of(kept), [r for r, g in zip(rows_of(docs), good) if g])


def test_near_dedup(spark, docs):
    kept = STAGES["SimHash near-dedup"](spark, docs, SF)
    assert kept.columns == docs.columns
    texts = rows_of(docs)
    found = classes([(i, plain_print(t)) for i, t in texts])
    groups = {least if least is not None else p: least for _, p, least in found}
    same_bag([i for i, _ in rows_of(kept)], list(groups.values()))
    assert 900_001 not in groups.values()


def test_decontamination(spark, docs):
    kept = STAGES["benchmark decontamination"](spark, docs, SF)
    assert kept.columns == docs.columns
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    texts = rows_of(docs)
    same_bag(rows_of(kept), [r for r, b in zip(texts, brute(texts, items)) if not b[5]])
    assert 900_003 not in [i for i, _ in rows_of(kept)]


def test_secret_masking(spark, docs):
    kept = STAGES["secret scans"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    for (i, text), (j, masked) in zip(sorted(rows_of(docs), key=str), sorted(rows_of(kept), key=str)):
        if not base(text) and secret_scan.MASK not in (masked or ""):
            assert masked == text
    assert [t for i, t in rows_of(kept) if i == 900_004] == [f"a clean text with {secret_scan.MASK} inside of it"]


def test_run_packs_what_is_left(spark, tokenizer):  # noqa: F811
    packed = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    texts = rows_of(docs)
    check(digest(packed), [(i, ids + [1]) for (i, _), ids in zip(texts, ids_of(tokenizer, [t for _, t in texts]))])


def test_empty_documents(spark, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
