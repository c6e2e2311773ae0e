"""Texts every operator has to cope with, and a comparison of rows in any order."""

import random

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
EXTRA = ["Score", "kept_id", "found_id", "text_key", "words", "found", "place", "span", "shard", "slot", "n_words", "print", "scan", "key", "id_",
         "hash_", "row", "items", "secret_spans", "kept", "copy", "labels"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in EXTRA]])


def odd_texts():
    """(doc_id, text): nulls, empty and blank texts, repeated rows, one very long text, every letter case."""
    rng = random.Random(5)
    words = ["Alpha", "beta", "ÉCOLE", "été", "x1", "don't", "a.b", "straße", " İs", "日本語", "Zz"]
    some = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(40, 70)]
    return [(1, None), (2, ""), (3, " \n\t "), (None, None), (None, "no id here at all, but a text"), (None, "no id here at all, but a text"),
            (4, "one"), (4, "one"), (5, "One"), (6, "\x00\x1c\x85  odd  spaces\r\n\x0bhere　"), (7, "𝔘𝔫𝔦 😀 😀 codé"),
            (8, "long " * 20_000), (9, "a b c d e f g h i j k l m n o p q r s t u v w x y z"), *some]


def same_bag(left, right):
    assert sorted(map(repr, left)) == sorted(map(repr, right))
