import math
import re
from collections import Counter

import pytest
from cases import SF, odd_texts, same_bag

from eventlake.llm import ranked
from eventlake.llm.queries import QUERIES

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def brute(docs, items, top=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in counted:
            m = 100 - 75 + (75 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:top], 1)]
    return out


ITEMS = [(1, "Alpha beta beta x1"), (2, "ÉCOLE été straße İs"), (3, None), (4, ""), (5, "no such word: qqqq"), (6, "long one 日本語"),
         (1, "Alpha beta beta x1"), (7, "Alpha beta beta x1"), (None, "don't a.b ZZ"), (8, "codé 𝔘𝔫𝔦 odd spaces here"), (9, "beta " * 500)]


@pytest.mark.parametrize(("top", "postings"), [(10, ranked.BLOCK_POSTINGS), (3, 4), (1000, 7)])
def test_odd_texts(spark, odd_docs, top, postings):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("score", ranked.F.lit("clash"))
    found = ranked.rank_documents(odd_docs, items, top, postings).collect()
    same_bag([tuple(r) for r in found], brute(odd_texts(), ITEMS, top))


def test_small_steps_give_the_same(spark, odd_docs, monkeypatch):
    """Few cells at a time, and one posting list longer than that."""
    rows = list(odd_texts())
    index = ranked.build_index(ranked.pa.table({"text_key": ["a", "b", "c", "a"], "term": ["beta", "beta", "beta", "x1"], "times": [1, 2, 3, 1]}))
    held = ranked.Weighted(index, ranked.np.array([7, 11]), 40, 1000)
    counted = ranked._counts(index.numbers, [t and t.encode() for _, t in rows])
    whole = ranked._scores(held, *counted, 0, len(rows))
    monkeypatch.setattr(ranked, "CELLS", 2)
    assert (ranked._scores(held, *counted, 0, len(rows)) == whole).all() and whole.any()
    assert (ranked._scores(held, *counted, 3, 9) == whole[3:9]).all()


def test_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = items.where("false")
    names = ["item_id", "rank", "doc_id", "score"]
    for found in (ranked.rank_documents(no_docs, items), ranked.rank_documents(odd_docs, none), ranked.rank_documents(no_docs, none)):
        assert found.columns == names and found.count() == 0


def test_ties_over_many_partitions(spark):
    docs = spark.range(3000).selectExpr("3000 - id AS doc_id", "'same words here' AS text").union(
        spark.range(50).selectExpr("10000 + id AS doc_id", "'other text' AS text")).repartition(40)
    items = spark.createDataFrame([(1, "words other"), (2, "same")], "item_id long, text string")
    found = ranked.rank_documents(docs, items).collect()
    rows = [(3000 - i, "same words here") for i in range(3000)] + [(10000 + i, "other text") for i in range(50)]
    same_bag([tuple(r) for r in found], brute(rows, [(1, "words other"), (2, "same")]))


def test_query_against_brute_force(spark, given_docs):
    import pyarrow.parquet as pq

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    found = QUERIES["op11_ranked_documents"](spark, SF).collect()
    same_bag([tuple(r) for r in found], brute([(d["doc_id"], d["text"]) for d in given_docs], items))
