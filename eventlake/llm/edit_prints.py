"""Document fingerprints by a randomised edit embedding, banding of sampled bits, verification.

A walk reads a text character by character into a longer string: at every step it writes the character
it stands on, and a shared random bit, which depends on the step and on the character alone, says
whether it goes on to the next. Walks over two texts that differ by few edits drift back together behind
each edit, so edit distance becomes Hamming distance between the written strings. A fingerprint samples
places of those strings. Fingerprints that agree in a whole band of samples are candidates, and all
samples together decide.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlake.llm.common import prepare_python, stored
from eventlake.llm.simhash import Forest, connected
from eventlake.operators.joins import checked_broadcast

SEED = 20240311
WALKS, PERIOD = 2, 1 << 12      # random bits repeat after PERIOD steps
SLOTS, BAND = 96, 8             # samples of a fingerprint, samples of a band
LIKENESS = 0.8
TASK_BYTES = 64 << 20
GROUP_CHARS = 1 << 21
BROADCAST_ROWS = 1 << 20
CHUNK_ROWS, FLUSH_ROWS = 1 << 14, 1 << 15
LEADERS, BLOCK = 64, 128
FARTHEST = 1 << 48              # no text is written to more places

CELLS = 1 << 20                 # characters, padding included, that are walked side by side
FEWEST = 24                     # texts worth walking side by side

Print = bytes


def _stays(rng: np.random.Generator) -> np.ndarray:
    """For each kind of character and step, how many steps a walk stays: to the next set bit."""
    bits = rng.integers(0, 2, (256, PERIOD), dtype=np.int64)
    bits[:, ::64] = 1  # so that every stay ends
    ahead = np.concatenate([bits, bits], axis=1)
    place = np.where(ahead == 1, np.arange(2 * PERIOD), 2 * PERIOD)
    following = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1]
    return (following - np.arange(2 * PERIOD))[:, :PERIOD].astype(np.uint8) + 1


def _sampled(rng: np.random.Generator) -> np.ndarray:
    """Places a slot samples, ascending: of the first m places it takes the last one in its row.

    A row holds the record lows of one random value per place, so a slot is uniform over any number of
    places and seldom moves when that number changes a little.
    """
    rows = []
    for _ in range(SLOTS):
        places, record = [], 1
        while record <= FARTHEST:
            places.append(record - 1)
            record = int(record / rng.random()) + 1
        rows.append(places)
    longest = max(map(len, rows))
    return np.array([r + [FARTHEST] * (longest - len(r)) for r in rows], np.int64)


_RNG = np.random.default_rng(SEED)
STAYS = np.stack([_stays(_RNG) for _ in range(WALKS)])  # walk, kind, step
SAMPLED = _sampled(_RNG)


def kinds_of(texts: list[str]) -> list[np.ndarray]:
    """Characters as kinds 1 to 255, by a hash of the code point."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    kinds = ((points * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return np.split(kinds, np.cumsum([len(t) for t in texts])[:-1]) if texts else []


def _walk_alone(kinds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.empty((WALKS, len(kinds) + 1), np.int64)
    for w in range(WALKS):
        stays, step, steps, last = [bytes(row) for row in STAYS[w]], int(starts[w]), [], PERIOD - 1
        reach = steps.append
        for kind in kinds.tobytes():
            reach(step)
            step += stays[kind][step & last]
        reach(step)
        out[w] = steps
    return out


def _walk_together(kinds: list[np.ndarray], starts: np.ndarray) -> list[np.ndarray]:
    """Texts of like length, one character of each at a time."""
    longest, flat = max(map(len, kinds)), STAYS.ravel()
    rows = np.zeros((longest, 1, len(kinds)), np.int64)
    for i, own in enumerate(kinds):
        rows[:len(own), 0, i] = own
    rows = (rows + 256 * np.arange(WALKS)[None, :, None]) * PERIOD
    steps, now = np.empty((longest + 1, WALKS, len(kinds)), np.int64), starts.T.astype(np.int64)
    steps[0] = now
    for k in range(longest):
        now = now + flat[(now & (PERIOD - 1)) + rows[k]]
        steps[k + 1] = now
    return [steps[:len(own) + 1, :, i].T.copy() for i, own in enumerate(kinds)]


def walk(kinds: list[np.ndarray], starts: np.ndarray | None = None) -> list[np.ndarray]:
    """For each text an array (walk, character): the step at which a walk comes to it, and behind the last.

    Texts of like length are walked side by side, ``CELLS`` characters at a time; where these are few,
    as for very long texts, one after the other.
    """
    starts = np.zeros((len(kinds), WALKS), np.int64) if starts is None else starts
    order = sorted(range(len(kinds)), key=lambda i: len(kinds[i]))
    out: list = [None] * len(kinds)
    while order:
        size = max(1, CELLS // (len(kinds[order[-1]]) + 1))
        group, order = order[-size:], order[:-size]
        if len(group) < FEWEST:
            for i in group:
                out[i] = _walk_alone(kinds[i], starts[i])
        else:
            for i, steps in zip(group, _walk_together([kinds[i] for i in group], starts[group])):
                out[i] = steps
    return out


def sample(kinds: np.ndarray, steps: np.ndarray) -> Print:
    """One kind per slot, slots dealt to the walks in turn; zeros for an empty text."""
    out = np.zeros(SLOTS, np.uint8)
    for w in range(WALKS if len(kinds) else 0):
        places = SAMPLED[w::WALKS]
        taken = places[np.arange(len(places)), (places < steps[w, -1]).sum(1) - 1]
        out[w::WALKS] = kinds[np.searchsorted(steps[w], taken, "right") - 1]
    return out.tobytes()


def fingerprint(text: str | None) -> Print:
    kinds = kinds_of([text or ""])
    return sample(kinds[0], walk(kinds)[0])


def likeness(a: Print, b: Print) -> float:
    """The share of slots that agree."""
    return float((np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).mean())


class _Walked(NamedTuple):
    """A text with its walks, so that a text with the same beginning need not walk it again."""

    doc_id: int | None
    text: str
    kinds: np.ndarray
    steps: np.ndarray
    print: Print


def _walked(ids: list, texts: list[str]) -> list[_Walked]:
    kinds = kinds_of(texts)
    return [_Walked(i, t, k, s, sample(k, s)) for i, t, k, s in zip(ids, texts, kinds, walk(kinds))]


def _edited(rows: list[tuple[_Walked, _Walked]]) -> list[tuple[str, Print]]:
    """Each text with its last half replaced by as much of the next, and the fingerprint of that."""
    halves = [len(own.text) // 2 for own, _ in rows]
    keeps = [len(own.text) - half for half, (own, _) in zip(halves, rows)]
    heads = [following.kinds[:half] for half, (_, following) in zip(halves, rows)]
    more = walk(heads, np.array([own.steps[:, keep] for keep, (own, _) in zip(keeps, rows)]))
    out = []
    for half, keep, head, steps, (own, following) in zip(halves, keeps, heads, more, rows):
        kinds = np.concatenate([own.kinds[:keep], head])
        whole = np.concatenate([own.steps[:, :keep], steps], axis=1)
        out.append((own.text[:keep] + following.text[:half], sample(kinds, whole)))
    return out


RESULT = ("doc_id long, n_chars long, edited_sha256 string, print binary, edited_print binary, near_edited double, "
          "near_next double, part int, role string, text string")
_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _results(rows: list[tuple[_Walked, _Walked]], part: int) -> list[tuple]:
    out = []
    for (own, following), (text, edited) in zip(rows, _edited(rows) if rows else []):
        out.append((own.doc_id, len(own.text), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), own.print, edited,
                    likeness(own.print, edited), likeness(own.print, following.print), part, None, None))
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[c.split()[1]]) for i, c in enumerate(RESULT.split(", "))], _NAMES)


def _groups(batch: pa.RecordBatch, columns: list[str]) -> Iterator[list[list]]:
    """Parts of a batch with some ``GROUP_CHARS`` characters of text, or one long text."""
    values = [batch.column(c).to_pylist() for c in columns]
    sizes = np.cumsum([len(t) for t in values[1]])
    at = 0
    while at < len(sizes):
        upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + GROUP_CHARS)))
        yield [v[at:upto] for v in values]
        at = upto


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of a task's ordered rows but the last; the first and last rows go on with their texts."""
    part, before = TaskContext.get().partitionId(), None
    for batch in batches:
        for ids, texts in _groups(batch, ["doc_id", "text"]):
            own = _walked(ids, texts)
            first = [] if before else [(ids[0], *[None] * 6, part, "first", texts[0])]
            line = [before, *own] if before else own
            yield _batch([*first, *_results(list(zip(line, line[1:])), part)])
            before = own[-1]
    if before is not None:
        yield _batch([(before.doc_id, *[None] * 6, part, "last", before.text)])


def _at_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, texts, following, part in _groups(batch, ["doc_id", "text", "next_text", "part"]):
            rows = zip(_walked(ids, texts), _walked(ids, following))
            yield _batch([r for pair, p in zip(rows, part) for r in _results([pair], p)])


def compare_in_order(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, beside the next document's.

    (doc_id, n_chars, edited_sha256, print, edited_print, near_edited, near_next). Documents go by
    ascending doc_id, a null doc_id last, equal ones by a hash of the text; the first follows the last.
    Null texts are empty. Repeated rows are documents of their own. Other columns are not read.

    Texts are range-partitioned once and read in order. Only the first and last row of a task wait for
    their neighbours in other tasks; one number per task meets in a window without a key.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    if partitions is None:
        size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = texts.select("doc_id", "text", *[c.alias(f"key{k}") for k, c in enumerate(order)])
    keys = [f"key{k}" for k in range(len(order))]
    ordered = keyed.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    made = stored(ordered.mapInArrow(_in_order, RESULT))
    ends = made.where("role IS NOT NULL")
    firsts = ends.where("role = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    wrapped = F.coalesce(F.lead("next_part").over(Window.orderBy("next_part")), F.min("next_part").over(Window.partitionBy()))
    following = firsts.select(F.col("next_part").alias("part"), wrapped.alias("next_part"))
    waiting = ends.where("role = 'last'").select("doc_id", "text", "part").join(following, "part").join(firsts, "next_part")
    done = waiting.select("doc_id", "text", "next_text", "part").mapInArrow(_at_ends, RESULT)
    return made.where("role IS NULL").unionByName(done).drop("part", "role", "text")


def print_number(fingerprint: Column) -> Column:
    """64 bits that stand for a fingerprint in joins."""
    return F.xxhash64(fingerprint)


def linked_prints(prints: np.ndarray, most: int) -> np.ndarray:
    """The least member each row of ``prints`` is connected to by links of at most ``most`` differing slots.

    First some members in turn take all that are near them; usually one takes all. Then what is still
    apart is compared in blocks, those of one set being left out.
    """
    forest, alive = Forest(len(prints)), np.arange(len(prints))
    for _ in range(LEADERS):
        if not len(alive):
            break
        near = (prints[alive] != prints[alive[0]]).sum(1) <= most
        forest.merge(alive[near], np.full(near.sum(), alive[0]))
        alive = alive[~near]
    if (forest.root == forest.root[0]).all():
        return forest.root
    order = np.argsort(forest.root, kind="stable")
    for at in range(0, len(order), BLOCK):
        one = order[at:at + BLOCK]
        for to in range(at, len(order), 8 * BLOCK):
            two = order[to:to + 8 * BLOCK]
            roots = forest.root[one], forest.root[two]
            if (roots[0] == roots[0][0]).all() and (roots[1] == roots[0][0]).all():
                continue
            i, j = np.nonzero((prints[one][:, None] != prints[two][None]).sum(2) <= most)
            forest.merge(one[i], two[j])
    return forest.root


def _search(most: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0

        def links(part: pd.DataFrame) -> pd.DataFrame:
            cells, numbers = part["cell"].to_numpy(), part["number"].to_numpy()
            prints = np.frombuffer(b"".join(map(bytes, part["print"])), np.uint8).reshape(len(part), SLOTS)
            first = np.searchsorted(cells, cells)
            near = (prints != prints[first]).sum(1) <= most
            a, b = [numbers[near]], [numbers[first[near]]]
            for start in np.unique(first[~near]):
                own = slice(start, int(np.searchsorted(cells, cells[start], "right")))
                a.append(numbers[own])
                b.append(numbers[own][linked_prints(prints[own], most)])
            one, two = np.concatenate(a), np.concatenate(b)
            return pd.DataFrame({"a": np.maximum(one, two), "b": np.minimum(one, two)})[one != two]

        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows < FLUSH_ROWS:
                continue
            whole = pd.concat(held, ignore_index=True)
            cut = int(np.searchsorted(whole["cell"].to_numpy(), whole["cell"].iloc[-1], "left"))
            held, rows = [whole.iloc[cut:]], len(whole) - cut
            if cut:
                yield links(whole.iloc[:cut])
        if rows:
            yield links(pd.concat(held, ignore_index=True))

    return run


def near_links(prints: DataFrame, least: float = LIKENESS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Links (a > b) that connect all distinct fingerprints (number, print) with a common band and enough
    common slots.

    Fingerprints with a common band are a cell. Only links of a spanning forest of every cell are
    returned. A cell with more than ``chunk_rows`` members is cut into chunks, and each pair of chunks
    becomes a cell, so no task takes more than two chunks and no link is lost.
    """
    prepare_python(prints.sparkSession)
    bands = F.array(*[F.xxhash64(F.lit(b), F.substring("print", b * BAND + 1, BAND)) for b in range(SLOTS // BAND)])
    shared = stored(prints.select(F.explode(bands).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    members = prints.select("number", "print", F.explode(bands).alias("bucket")).join(checked_broadcast(shared, BROADCAST_ROWS), "bucket")
    chunks = F.ceil(F.col("n") / chunk_rows)
    chunk = F.pmod(F.xxhash64("number"), chunks)
    pairs = F.when(F.col("n") <= chunk_rows, F.array(F.lit(0).cast("long"))).otherwise(F.transform(
        F.sequence(F.lit(0).cast("long"), chunks - 1), lambda other: F.least(chunk, other) * (1 << 31) + F.greatest(chunk, other)))
    cells = members.select("number", "print", "bucket", F.explode(pairs).alias("pair")).select(
        F.xxhash64("bucket", "pair").alias("cell"), "number", "print")
    most = math.floor((1 - least) * SLOTS + 1e-9)
    return cells.repartition("cell").sortWithinPartitions("cell").mapInPandas(_search(most), "a long, b long").distinct()


def near_documents(prints: DataFrame, least: float = LIKENESS) -> DataFrame:
    """(doc_id, print) rows with ``near_id``, the least doc_id of all fingerprints linked to theirs.

    Equal fingerprints are one node, whatever their number. ``near_id`` is null only where no document
    of the class has an id. With ``least`` 0.8, a link is a candidate with probability above 0.88.
    """
    numbered = prints.withColumn("number", print_number(F.col("print")))
    nodes = stored(numbered.groupBy("number").agg(F.first("print").alias("print"), F.min("doc_id").alias("first_id")))
    roots = connected(near_links(nodes.select("number", "print"), least))
    ends = roots.select(F.col("root").alias("node"), "root").distinct()
    placed = nodes.select("number", "first_id").join(roots.unionByName(ends).distinct(), F.col("number") == F.col("node"), "left") \
        .select("number", "first_id", F.coalesce("root", "number").alias("root"))
    classes = placed.groupBy("root").agg(F.min("first_id").alias("near_id"))
    classed = placed.select("number", "root").join(classes, "root").select("number", "near_id")
    return numbered.join(classed, "number").drop("number")


def fingerprints(docs: DataFrame, least: float = LIKENESS, partitions: int | None = None) -> DataFrame:
    """Every document's fingerprint, how near the edited text and the next document are, and its class.

    The columns of ``compare_in_order`` and ``near_id`` of ``near_documents``. An empty table gives none.
    """
    return near_documents(compare_in_order(docs, partitions), least)
