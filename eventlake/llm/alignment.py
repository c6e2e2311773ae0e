"""Alignment of two tokenizers' tokens over a corpus, each distinct text tokenized once.

Documents are shuffled by their full text, so copies meet and only their number goes on. Every distinct
text is tokenized both ways and cut where tokens of both end at the same byte. Counts of linked id pairs
are weighted by the number of copies, and the measures of a text are joined back to its documents.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventlake.llm.common import prepare_python, stored
from eventlake.llm.packing import byte_of_sign, encoder
from eventlake.session import scratch_dir

GROUP_CHARS = 1 << 21      # characters of the texts aligned together
REMEMBERED = 1 << 18       # words whose pieces a worker remembers
BROADCAST_PAIRS = 1 << 19  # id pairs broadcast at most
WORD = re.compile(" *[^ ]+| +")
MARK = "▁"            # the piece model's sign for a space


class ByteTokens:
    """Ids and bytes of a byte-level BPE file; strings of added tokens are ordinary text."""

    def __init__(self, path: str):
        byte = byte_of_sign()
        vocabulary = json.loads(Path(path).read_text(encoding="utf-8"))["model"]["vocab"]
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(byte.get(c, 0) for c in token)
        self.encode = encoder(path)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, "<u4").astype(np.int64) for ids in self.encode(texts)]


class PieceTokens:
    """Ids and bytes of a piece model; its own mark is put before the text.

    Where no piece has a space behind another character, words with the spaces before them are encoded
    one by one with the same result, and their pieces are remembered.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode()
                      for i, p in enumerate(pieces)]
        self.by_words = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.known: dict[str, list[int]] = {}

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """``texts`` with the space in front that the model itself puts there."""
        if not self.by_words:
            return [np.array(ids, np.int64) for ids in self.model.encode([t[1:] for t in texts], num_threads=1)]
        out = []
        for text in texts:
            words = WORD.findall(text)
            new = [w for w in dict.fromkeys(words) if w not in self.known]
            if len(self.known) + len(new) > REMEMBERED:
                self.known, new = {}, list(dict.fromkeys(words))
            self.known.update(zip(new, self.model.encode([w[1:] for w in new], num_threads=1)))
            if " " in words:  # the model gives nothing for an empty text
                self.known[" "] = [self.model.piece_to_id(MARK)]
            out.append(np.fromiter(chain.from_iterable(map(self.known.__getitem__, words)), np.int64))
        return out


class Aligner:
    """Both tokenizers and what is needed to write groups of their tokens."""

    def __init__(self, byte_file: str, piece_file: str):
        self.a, self.b = ByteTokens(byte_file), PieceTokens(piece_file)
        self.sizes = [np.array([len(t) for t in side.bytes], np.int64) for side in (self.a, self.b)]
        # an id with the sign behind it: within a side, after its last token of a group
        self.written = [f"{i}{sign}" for side, last in ((self.a, "|"), (self.b, ";")) for i in range(len(side.bytes))
                        for sign in (",", last)]

    def __call__(self, texts: list[str], digest: bool) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text, None where it has no tokens."""
        texts = [" " + t for t in texts]
        tokens = [side(texts) for side in (self.a, self.b)]
        plain = [t.encode("utf-8", "surrogatepass") for t in texts]
        # pieces of A are cut from the text's own bytes, so their length tells whether all are there
        good = [i for i, data in enumerate(plain) if len(data) > 1 and self.sizes[0][tokens[0][i]].sum() == len(data)
                and b"".join(map(self.b.bytes.__getitem__, tokens[1][i].tolist())) == data]
        out: list[tuple] = [(0, 0, 0, 0, "", None, None)] * len(texts)
        if not good:
            return out
        a, b = (np.concatenate([ids[i] for i in good]) for ids in tokens)
        n_a, n_b = (np.array([len(ids[i]) for i in good]) for ids in tokens)
        stops = np.concatenate([np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])])
        order = np.argsort(stops, kind="stable")  # merges two ascending runs
        ascending = stops[order]
        new = np.concatenate([[True], ascending[1:] != ascending[:-1]])
        part_of = np.empty(len(stops), np.int64)
        part_of[order] = np.cumsum(new) - 1       # a part lies in one token of either side
        part_a, part_b, parts = part_of[:len(a)], part_of[len(a):], ascending[new]
        is_a, is_b = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        is_a[part_a] = is_b[part_b] = 1
        cut = is_a & is_b                         # tokens of both end: a group does, as does every text
        group = np.cumsum(cut) - cut
        in_a, in_b = group[part_a], group[part_b]
        a_upto, b_upto = (np.concatenate([[0], np.cumsum(np.bincount(g))]) for g in (in_a, in_b))
        signs = np.empty(len(stops), np.int64)    # group by group, A before B
        signs[np.arange(len(a)) + b_upto[in_a]] = 2 * a + cut[part_a]
        signs[np.arange(len(b)) + a_upto[in_b + 1]] = 2 * (len(self.a.bytes) + b) + cut[part_b]
        text_of = np.searchsorted(np.cumsum([len(plain[i]) for i in good]), parts)
        n_groups, n_links = np.bincount(text_of, cut).astype(np.int64), np.bincount(text_of)
        linked = a[np.cumsum(is_a) - is_a] * len(self.b.bytes) + b[np.cumsum(is_b) - is_b]
        upto, most = np.concatenate([[0], np.cumsum(n_a + n_b)]), len(self.a.bytes) * len(self.b.bytes)
        keys = np.sort(text_of * most + linked)
        first_of = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, times = keys[first_of], np.diff(np.append(first_of, len(keys)))
        first = np.searchsorted(keys, np.arange(len(good) + 1) * most)
        for k, i in enumerate(good):
            groups = "".join(map(self.written.__getitem__, signs[upto[k]:upto[k + 1]].tolist()))[:-1]
            own = slice(first[k], first[k + 1])
            out[i] = (int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_links[k]),
                      hashlib.sha256(groups.encode()).hexdigest() if digest else groups, keys[own] - k * most, times[own])
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_file: str, piece_file: str) -> Aligner:
    if (byte_file, piece_file) not in _ALIGNERS:
        _ALIGNERS[byte_file, piece_file] = Aligner(byte_file, piece_file)
    return _ALIGNERS[byte_file, piece_file]


MEASURES = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = ("text_key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "links array<struct<pair: long, times: long>>")


def _aligned(files: tuple[str, str], digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = aligner(*files)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = np.cumsum([len(t) for t in texts])
            at = 0
            while at < len(texts):  # a part of the batch, or one long text
                upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + GROUP_CHARS)))
                rows = made(texts[at:upto], digest)
                none = np.zeros(0, np.int64)
                pairs, times = ([none if r[k] is None else r[k] for r in rows] for k in (5, 6))
                flat = pa.StructArray.from_arrays([pa.array(np.concatenate(pairs)), pa.array(np.concatenate(times).astype(np.int64))],
                                                  ["pair", "times"])
                starts = np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int32)
                numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("text_key")[at:upto], batch.column("copies")[at:upto], *numbers,
                     pa.array([r[4] for r in rows], pa.string()), pa.ListArray.from_arrays(pa.array(starts), flat)],
                    ["text_key", "copies", *MEASURES, "groups", "links"])
                at = upto

    return run


def exact_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class Alignment(NamedTuple):
    """``texts`` has a row per distinct text, ``pairs`` one per linked id pair of the corpus.

    ``texts``: text_key, copies, n_a, n_b, n_groups, n_links, groups and links (pair, times), the pair
    being the A id times the size of the B vocabulary plus the B id. ``pairs``: pair, a_id, b_id, n and
    whether n is the highest of its B id.
    """

    texts: DataFrame
    pairs: DataFrame


def align_texts(docs: DataFrame, byte_file: str, piece_file: str, digest: bool = False) -> Alignment:
    """Align every distinct text once; the result is stored in the shared scratch folder.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``, ids in order, or only its SHA-256 with ``digest``. Null and
    empty texts are left out; a text that either tokenizer does not give back byte by byte has no
    tokens, and '' as groups.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    distinct = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    made = distinct.select(exact_key(F.col("text")).alias("text_key"), "text", "copies").mapInArrow(
        _aligned((byte_file, piece_file), digest), ALIGNED)
    path = scratch_dir(spark, "alignment")
    made.write.parquet(path)
    texts = spark.read.schema(ALIGNED).parquet(path)
    counts = texts.select("copies", F.explode("links").alias("l")).groupBy("l.pair").agg(
        F.sum(F.col("copies") * F.col("l.times")).alias("n"))
    width = len(aligner(byte_file, piece_file).b.bytes)
    counts = stored(counts.withColumns({"a_id": F.expr(f"pair div {width}"), "b_id": F.col("pair") % width}))
    highest = counts.groupBy("b_id").agg(F.max("n").alias("most"))
    return Alignment(texts, counts.join(highest, "b_id").select("pair", "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best")))


def _frequent_from(pairs: DataFrame, limit: int) -> int | None:
    """The least power of two such that at most ``limit`` pairs occur that often; None if all pairs fit."""
    sizes = {r["bits"]: r["count"] for r in pairs.groupBy(F.length(F.bin("n")).alias("bits")).count().collect()}
    total = 0
    for bits in sorted(sizes, reverse=True):
        total += sizes[bits]
        if total > limit:
            return 1 << bits
    return None


def document_measures(docs: DataFrame, alignment: Alignment, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every document.

    ``count_sum`` adds up the corpus-wide counts of a document's links, ``n_best`` counts the links
    whose count is the highest of their B id, ties included. Null, empty and token-less texts have zeros
    and ''. Repeated rows and null doc_ids stay as they are; other columns are not read.

    The counts of the most frequent pairs, ``broadcast_pairs`` at most, are broadcast; links of rarer
    pairs meet their counts in a shuffle join, where no pair can be hot.
    """
    texts, pairs = alignment
    own = ["text_key", *MEASURES, "groups"]
    links = texts.select(*own, F.explode("links").alias("l")).select(*own, "l.pair", "l.times")
    pairs = stored(pairs.select("pair", "n", "best"))
    least = _frequent_from(pairs, broadcast_pairs)
    frequent = F.broadcast(pairs if least is None else pairs.where(F.col("n") >= least))
    counted = links.join(frequent, "pair")
    if least is not None:
        rare = links.join(frequent.select("pair"), "pair", "left_anti").join(pairs.where(F.col("n") < least), "pair")
        counted = counted.unionByName(rare)
    measured = counted.groupBy(*own).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                         F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    names = [*MEASURES, "n_best", "count_sum"]
    zero = F.lit(0).cast("long")
    keyed = docs.where("text <> ''").select("doc_id", exact_key(F.col("text")).alias("text_key"))
    found = keyed.join(measured, "text_key", "left").select(
        "doc_id", *[F.coalesce(n, zero).alias(n) for n in names], F.coalesce("groups", F.lit("")).alias("groups"))
    empty = docs.where("text IS NULL OR text = ''").select("doc_id", *[zero.alias(n) for n in names], F.lit("").alias("groups"))
    return found.unionByName(empty)
