import itertools
import zlib

import numpy as np
import pytest
from cases import SF, odd_texts, same_bag
from pyspark.sql import functions as F

from eventlake.llm import packing
from eventlake.llm.queries import QUERIES, tokenizer_path

SPACES = ["a  b", " a", "a ", "\n\na", "a\n b", "it's 's 'll x", "　 a  \t b\r\n\r\nc", "<|endoftext|> x <|endoftext|>", "a\x1c b\x1fc \x85d", "",
          "é ñ 日本 語\n語", "x" * 50 + " 1234 5 .. !!", " \n \n", "a b \n\n c\n", "\x00\x01 \x7f", "😀😀 😀", "İs ſt Ⅷ ½ ² ٣"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokenizer_path())
    made.encode_special_tokens = True
    return made


def ids_of(tokenizer, texts):
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_gives_the_tokenizers_ids(tokenizer, given_docs):
    texts = [d["text"] for d in given_docs] + SPACES
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.encoder(tokenizer_path())(texts)] == ids_of(tokenizer, texts)


def check(rows, expected, tokens=packing.SEQUENCE_TOKENS):
    """Pieces cover every document's ids once, sequences are gapless and full but for a few."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    room = []
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(parts[-1]) <= tokens
        room.append(tokens - sum(parts[-1]))
    pieces = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]) for r in rows))
    copies = {}
    for doc, ids in expected:
        copies.setdefault((doc is None, doc or 0, len(ids)), []).append(ids)
    for key, whole in copies.items():
        own = [p[3:] for p in pieces if p[:3] == key]
        assert sum(n for _, n, _ in own) == sum(map(len, whole))
        if len(whole) == 1:
            at = 0
            for start, length, crc in own:
                assert start == at and zlib.crc32(np.array(whole[0][start:start + length], "<u4").tobytes()) == crc
                at += length
    assert {p[:3] for p in pieces} == set(copies)
    return room


def digest(pieces):
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids").collect()


def test_query_is_an_exact_cut(spark, tokenizer, given_docs):
    rows = QUERIES["op7_packed_pieces"](spark, SF).collect()
    expected = [(d["doc_id"], ids + [1]) for d, ids in zip(given_docs, ids_of(tokenizer, [d["text"] for d in given_docs]))]
    room = check(rows, expected)
    assert sum(bool(r) for r in room) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_odd_texts(spark, tokenizer, odd_docs, no_docs):
    texts = odd_texts()
    expected = [(i, ids + [1]) for (i, _), ids in zip(texts, ids_of(tokenizer, [t for _, t in texts]))]
    check(digest(packing.pack(odd_docs, tokenizer_path(), partitions=3)), expected)
    check(digest(packing.pack(odd_docs, tokenizer_path(), tokens=7, partitions=2)), expected, 7)
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


def test_equal_texts_are_spread(spark):
    copies = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same words in every text").alias("text"))
    rows = packing.pack(copies, tokenizer_path(), partitions=8).select((F.col("sequence_id") / (1 << 40)).cast("int").alias("part"))
    sizes = [r["count"] for r in rows.groupBy("part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_hilbert_curve_visits_every_cell_by_single_steps():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    keys = packing.hilbert_key(cells, 3)
    walk = cells[np.argsort(keys)]
    assert sorted(keys) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_near_texts_have_near_points(given_docs):
    text = given_docs[0]["text"] * 5
    a, b, c = (packing.curve_point(t) for t in (text, text + " one more", "WHOLLY OTHER! 123 $$$ " * 40))
    assert np.abs(a - b).max() < np.abs(a - c).max()
    same_bag(packing.curve_point(None), packing.curve_point(""))


ADDED = ["a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> x  y <|endoftext|>\n\n<|endoftext", "é <|endoftext|>  日本 <|ENDOFTEXT|>",
         "<|endof<|endoftext|>text|>", "long  text <|endoftext|> " * 3000]


def test_added_tokens_in_texts_have_their_own_ids(spark, given_docs):
    from tokenizers import Tokenizer

    unmodified = Tokenizer.from_file(tokenizer_path())
    texts = ADDED + SPACES + [d["text"] for d in given_docs]
    ids = ids_of(unmodified, texts)
    assert ids[0] == [64, 50256, 65]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.document_encoder(tokenizer_path())(texts)] == ids
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    check(digest(packing.pack(docs, tokenizer_path(), partitions=2)), [(i, own + [1]) for i, own in enumerate(ids[:len(ADDED)])])


def test_tasks_take_equal_bytes(spark):
    """Short and long texts, a third of them copies: bytes of a task, not rows, are even."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the very same text again and again ").otherwise(
        F.concat(F.sha2(F.col("id").cast("string"), 256), F.lit(" "), F.repeat(F.hex(F.xxhash64("id")), (F.col("id") % 37 + 1).cast("int")))).alias("text"))
    pieces = packing.pack(docs, tokenizer_path(), partitions=40)
    tokens = sorted(r["n"] for r in pieces.groupBy((F.col("sequence_id") / (1 << 40)).cast("int").alias("part")).agg(
        F.sum("length").alias("n")).collect())
    assert len(tokens) == 40 and tokens[-1] < 1.5 * tokens[20]
