"""The registered queries of this package: each operator over its whole table, as result digests."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.llm import (
    alignment, chat, edit_prints, licences, line_blocks, neighbours, packing, quality_rules, ranked, secret_scan, sharding, simhash,
    winnowing)
from eventlake.llm.oracles import ORACLES
from eventlake.sources.tables import read_table

__all__ = ["ORACLES", "QUERIES"]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary file: in the folder TOKENIZER_DIR names, or where the package has it."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def quality_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    model = neighbours.fit(docs, read_table(spark, folder, "labels"))
    return neighbours.classify(docs, model).select("doc_id", "held_out", "score", "predicted")


def simhash_classes(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def packed_pieces(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, folder, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def winnowed_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    found = winnowing.overlaps(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(read_table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("secret_spans")
    kinds = F.transform(spans, lambda p: p["kind"])
    of_kind = [(F.size(spans) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{secret_scan.KINDS[k]}")
               for k in range(3)]
    base = secret_scan.written(F.filter(spans, lambda p: p["kind"] < 3))
    return found.select("doc_id", *of_kind, F.sha2(base, 256).alias("base_sha256"), secret_scan.written(spans).alias("spans"))


def chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    given = read_table(spark, folder, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digests(chat.windows(given.union(probe)))


SHARDS = 8


def shuffled_shards(spark: SparkSession, folder: str) -> DataFrame:
    done = sharding.shuffle(read_table(spark, folder, "documents"), SHARDS)
    return done.select(
        "doc_id", sharding.record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def risk_controlled_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    return judged.drop("failed_rules")


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return line_blocks.extract(read_table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def licence_labels(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan_licences(read_table(spark, folder, "documents").select("doc_id", "text"))
    return found.drop("text")


def ranked_documents(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.rank_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def aligned_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select(F.col("doc_id").cast("long"), "text")
    aligned = alignment.align_texts(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), digest=True)
    return alignment.document_measures(docs, aligned).withColumnRenamed("groups", "groups_sha256")


def edit_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = edit_prints.fingerprints(read_table(spark, folder, "documents").select("doc_id", "text"))
    prints = [F.lower(F.hex(c)).alias(n) for c, n in (("print", "fingerprint"), ("edited_print", "edited_fingerprint"))]
    return found.select("doc_id", "n_chars", "edited_sha256", *prints, "near_edited", "near_next", "near_id")


QUERIES = {
    "op1_quality_neighbours": quality_neighbours,
    "op2_winnowed_overlaps": winnowed_overlaps,
    "op3_shuffled_shards": shuffled_shards,
    "op4_secret_spans": secret_spans,
    "op5_simhash_classes": simhash_classes,
    "op6_chat_windows": chat_windows,
    "op7_packed_pieces": packed_pieces,
    "op8_risk_controlled_rules": risk_controlled_rules,
    "op9_page_texts": page_texts,
    "op10_licence_labels": licence_labels,
    "op11_ranked_documents": ranked_documents,
    "op12_aligned_tokens": aligned_tokens,
    "op13_edit_prints": edit_fingerprints,
}
