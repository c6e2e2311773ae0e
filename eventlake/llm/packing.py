"""Packing documents into fixed-length sequences along a space-filling curve.

A document's hashed byte pairs are projected to a few dimensions, and its place on the Hilbert curve
through that space is its sort key. The curve is cut into stretches of about equal bytes, so neighbours on
the curve meet in one task, and are tokenized there and laid end to end into sequences.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from eventlake.llm.common import on_texts, prepare_python

SEQUENCE_TOKENS, END_ID = 2048, 1
VECTOR_TERMS, AXES, AXIS_BITS, SEED = 512, 3, 16, 20240229
CHUNK = 1 << 20
CELL_BITS = 16            # the curve is weighed in 2 ** CELL_BITS cells
TASK_BYTES = 32 << 20     # of text, where that asks for more tasks than the session's partitions
SPACES = re.compile(r"\s\s")

_TERM = ((np.arange(1 << 16, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(55)).astype(np.int32)
_AXES = np.random.default_rng(SEED).standard_normal((VECTOR_TERMS, AXES))


def curve_point(text: str | None) -> np.ndarray:
    """The projected document vector as AXES integers of AXIS_BITS bits."""
    codes = np.frombuffer(b" " + (text or "").encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(VECTOR_TERMS)
    for at in range(0, len(codes) - 1, CHUNK):
        part = codes[at:at + CHUNK + 1].astype(np.int32)
        counts += np.bincount(_TERM[part[:-1] * 256 + part[1:]], minlength=VECTOR_TERMS)
    vector = np.sqrt(counts)
    vector /= max(float(np.linalg.norm(vector)), 1e-9)
    unit = 1 / (1 + np.exp(-1.702 * (vector @ _AXES)))  # about the normal distribution function
    return np.minimum((unit * (1 << AXIS_BITS)).astype(np.int64), (1 << AXIS_BITS) - 1)


def hilbert_key(points: np.ndarray, bits: int = AXIS_BITS) -> np.ndarray:
    """The Hilbert index of integer points (n, axes): Gray code undone over rotated, flipped axes."""
    x = points.astype(np.int64).copy()
    axes = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for a in range(axes):
            set_ = (x[:, a] & bit) != 0
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, a]) & low)
            x[:, 0] ^= np.where(set_, low, swap)
            x[:, a] ^= swap
    for a in range(1, axes):
        x[:, a] ^= x[:, a - 1]
    flips = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(x[:, -1] & (1 << level), (1 << level) - 1, 0)
    x ^= flips[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for a in range(axes):
            key = (key << 1) | ((x[:, a] >> level) & 1)
    return key


# Fixed values of the byte-level vocabulary: its rule for cutting a text into pieces. Where no two white
# space characters meet, the second form cuts alike and needs no look-ahead.
PIECE_RULE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE_RULE_SINGLE_SPACES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""


def byte_of_sign() -> dict[str, int]:
    """The vocabulary file writes printable bytes as they are and the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids by a byte-level BPE file of the tokenizers library, as little-endian bytes.

    The file's vocabulary is given to a faster engine, which merges by the same ranks. Here strings of
    added tokens inside a text are ordinary text; ``document_encoder`` gives them their own ids.
    """

    def __init__(self, path: str):
        import tiktoken

        held = json.loads(Path(path).read_text(encoding="utf-8"))
        special = {t["content"] for t in held.get("added_tokens", [])}
        byte = byte_of_sign()
        ranks = {bytes(byte[c] for c in token): rank for token, rank in held["model"]["vocab"].items()
                 if token not in special}
        self.whole, self.single = (
            tiktoken.Encoding(name, pat_str=rule, mergeable_ranks=ranks, special_tokens={})
            for name, rule in (("whole", PIECE_RULE), ("single", PIECE_RULE_SINGLE_SPACES)))

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [np.array((self.whole if SPACES.search(t) else self.single).encode_ordinary(t), "<u4").tobytes()
                for t in texts]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class DocumentEncoder:
    """Token ids as the tokenizers library gives them with ``add_special_tokens=False``.

    The library itself encodes the texts that hold an added token, such as ``<|endoftext|>``; the
    others go through ``Encoder``.
    """

    def __init__(self, path: str):
        added = [t["content"] for t in json.loads(Path(path).read_text(encoding="utf-8")).get("added_tokens", [])]
        self.path, self.ordinary, self.library = path, encoder(path), None
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")

    def whole(self, text: str) -> bytes:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        holding = [self.added.search(t) is not None for t in texts]
        others = iter(self.ordinary([t for t, h in zip(texts, holding) if not h]))
        return [self.whole(t) if h else next(others) for t, h in zip(texts, holding)]


_DOCUMENT_ENCODERS: dict[str, DocumentEncoder] = {}


def document_encoder(path: str) -> DocumentEncoder:
    if path not in _DOCUMENT_ENCODERS:
        _DOCUMENT_ENCODERS[path] = DocumentEncoder(path)
    return _DOCUMENT_ENCODERS[path]


PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long")
GROUP_CHARS = 1 << 21


def _pack(encode: Callable[[], Callable[[list[str]], list[bytes]]], tokens: int, end_id: int):
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoded, sequence, offset = encode(), TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            sizes = np.cumsum([len(t) for t in texts])
            at = 0
            while at < len(texts):  # a part of the batch, or one long text
                upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + GROUP_CHARS)))
                rows = []
                for doc_id, data in zip(ids[at:upto], encoded(texts[at:upto])):
                    data += tail
                    total, start = len(data) // 4, 0
                    doc_id = None if doc_id is None or doc_id != doc_id else int(doc_id)
                    while start < total:
                        length = min(total - start, tokens - offset)
                        rows.append((doc_id, start, length, data[4 * start:4 * (start + length)], total, sequence, offset))
                        start, offset = start + length, offset + length
                        if offset == tokens:
                            sequence, offset = sequence + 1, 0
                yield pd.DataFrame({n: pd.Series(c, dtype="Int64") if n != "ids" else list(c) for n, c in zip(
                    ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"), zip(*rows))})
                at = upto

    return run


def pack(docs: DataFrame, tokenizer: str, tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID,
         partitions: int | None = None) -> DataFrame:
    """One row per piece of a document: where it starts in the document and where it lies.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers. Every document ends
    with ``end_id``; null and empty texts are that id alone. An added token of the vocabulary inside a
    text, such as ``<|endoftext|>``, is its own id, as in the tokenizers library. Sequences are filled to ``tokens`` and
    documents cut where one is full, so only the last sequence of a task has room left. Tasks take equal
    bytes of the curve. A cell of the curve that holds more than a task's share, such as a large group of
    copies, is spread by a hash of ids and places in the input, so it does not end in one task. An empty table gives no pieces. Other
    columns of ``docs`` are not read.
    """
    prepare_python(docs.sparkSession)
    where = str(Path(tokenizer))
    keys = on_texts(lambda texts: [(int(k),) for k in hilbert_key(np.stack([curve_point(t) for t in texts]))]
                    if texts else [], "k long")
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", keys(F.col("text"))["k"].alias("key"), F.xxhash64("doc_id").alias("spread"),
        F.monotonically_increasing_id().alias("row"))
    size = F.octet_length("text").cast("long") + 1
    weighed = keyed.groupBy(F.shiftright("key", AXES * AXIS_BITS - CELL_BITS).alias("cell")).agg(F.sum(size).alias("bytes"))
    cells = sorted((r["cell"], r["bytes"]) for r in weighed.collect())  # 2 ** CELL_BITS at most
    total = sum(b for _, b in cells)
    count = partitions or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    ends = np.cumsum([0, *(b for _, b in cells)]).tolist()
    line = docs.sparkSession.createDataFrame([(c, end, b) for (c, b), end in zip(cells, ends)], "cell long, before long, bytes long")
    within = F.pmod(F.xxhash64("spread", "row"), F.lit(1 << 20)) / (1 << 20)
    part = F.floor((F.col("before") + within * F.col("bytes")) * count / max(total, 1))
    placed = keyed.withColumn("cell", F.shiftright("key", AXES * AXIS_BITS - CELL_BITS)).join(F.broadcast(line), "cell").withColumn(
        "part", F.least(part, F.lit(count - 1)).cast("int"))
    along = placed.repartitionById(count, "part").sortWithinPartitions("key", "spread", "row")
    return along.select("doc_id", "text").mapInPandas(_pack(lambda: document_encoder(where), tokens, end_id), PIECES)
