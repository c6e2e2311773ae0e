import hashlib
import re

import pytest
from cases import SF, odd_texts, same_bag

from eventlake.llm import winnowing
from eventlake.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(texts, items):
    """Every window of every item looked up in every document."""
    out = []
    for doc_id, text in texts:
        own, hit, met = words(text), set(), set()
        for item_id, item in items:
            other = words(item)
            n = min(13, len(other))
            windows = {tuple(other[i:i + n]) for i in range(len(other) - n + 1)} if n else set()
            for i in range(len(own) - n + 1):
                if tuple(own[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    met.add(item_id)
        met.discard(None)
        ids = ",".join(sorted(map(str, met)))
        out.append((doc_id, len(own), len(hit), len(met), hashlib.sha256(ids.encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(own)))
    return out


def digest(found):
    return [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(
        ",".join(sorted(map(str, r["items"]))).encode()).hexdigest(), r["contaminated"]) for r in found.collect()]


LONG = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
ITEMS = [(1, "A b C d e f g h i j k l m n o p"), (2, "beta"), (3, None), (4, "..."), (5, "x1 don t"), (6, "one"), (10, "long " * 30),
         (11, "no id here at all, but a text"), (None, "o p q r s t u v w x y z"), (12, LONG[10:40]), (12, LONG[20:]), (1, LONG)]


def test_odd_texts_and_short_items(spark, odd_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    same_bag(digest(winnowing.overlaps(odd_docs, items)), brute(odd_texts(), ITEMS))


def test_shuffle_join_gives_the_same(spark, odd_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    same_bag(digest(winnowing.overlaps(odd_docs, items, broadcast_rows=0)), brute(odd_texts(), ITEMS))


def test_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert winnowing.overlaps(no_docs, none).count() == 0
    assert {r["n_hit"] for r in winnowing.overlaps(odd_docs, none).collect()} == {0}
    kept = winnowing.decontaminate(odd_docs, none)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_decontaminate_keeps_the_rest(spark, odd_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = [(r[0], t) for r, (_, t) in zip(brute(odd_texts(), ITEMS), odd_texts()) if not r[5]]
    kept = winnowing.decontaminate(odd_docs, items)
    same_bag([(r["doc_id"], r["text"]) for r in kept.collect()], clean)


@pytest.mark.parametrize("folder", [SF])
def test_query_against_brute_force(spark, folder, given_docs):
    import pyarrow.parquet as pq

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    found = QUERIES["op2_winnowed_overlaps"](spark, folder).collect()
    same_bag([tuple(r) for r in found], brute([(d["doc_id"], d["text"]) for d in given_docs], items))
