"""A corpus from raw documents to packed sequences, one stored stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.llm import neighbours, packing, secret_scan, simhash, winnowing
from eventlake.llm.queries import tokenizer_path
from eventlake.session import scratch_dir
from eventlake.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the neighbour classifier does not reject; fitted on the labels of its own input."""
    model = neighbours.fit(docs, read_table(spark, sf_dir, "labels"))
    scored, columns = docs.select(F.struct("*").alias("row"), "doc_id", "text"), docs.columns
    kept = neighbours.classify(scored, model).where("predicted = 1")
    return kept.select(*[F.col("row")[c].alias(c) for c in columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked fingerprints."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return winnowing.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in the text."""
    return secret_scan.mask_secrets(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, with their token ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_masking),
    ("packing", sequence_packing),
]

ORACLE_SQL = None  # a neighbour vote and a tokenizer have no SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name.replace(' ', '-').lower()}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
