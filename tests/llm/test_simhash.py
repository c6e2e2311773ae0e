import numpy as np
import pytest
import xxhash
from cases import SF, odd_texts, same_bag
from pyspark.sql import functions as F

from eventlake.llm import simhash
from eventlake.llm.queries import QUERIES


def plain_print(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in lower.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows):
    """(id, print) rows to (id, print, least id reachable), comparing all pairs."""
    prints = sorted({p for _, p in rows})
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[top(b)] = top(a)
    least = {}
    for doc, p in rows:
        if doc is not None:
            least[top(p)] = min(doc, least.get(top(p), doc))
    return [(doc, f"{p:016x}", least.get(top(p))) for doc, p in rows]


def test_query_against_brute_force(spark, given_docs):
    rows = [(d["doc_id"], plain_print(d["text"])) for d in given_docs]
    same_bag([tuple(r) for r in QUERIES["op5_simhash_classes"](spark, SF).collect()], classes(rows))


def test_odd_texts(spark, odd_docs, no_docs):
    found = simhash.near_duplicates(odd_docs).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")), "component_id")
    same_bag([tuple(r) for r in found.collect()], classes([(i, plain_print(t)) for i, t in odd_texts()]))
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def planted(rng, groups=60, spread=6):
    out = []
    for _ in range(groups):
        code = int(rng.integers(0, 2**63)) * 2
        for _ in range(int(rng.integers(1, 25))):
            near = code
            for bit in rng.integers(0, 64, int(rng.integers(0, spread))):
                near ^= 1 << int(bit)
            out.append(near)
    return sorted(set(out))


@pytest.mark.parametrize("cell_rows", [1 << 20, 3])
def test_links_connect_what_all_pairs_connect(spark, cell_rows):
    """With tiny cells every slice is cut into chunk pairs."""
    codes = planted(np.random.default_rng(cell_rows), groups=25 if cell_rows == 3 else 60)
    codes += [c ^ 1 << 40 for c in codes[:5]] + [0, 7, 1 << 63, (1 << 64) - 1]
    codes = sorted(set(codes))
    signed = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "print long")
    roots = simhash.connected(simhash.links(signed, cell_rows=cell_rows)).collect()
    found = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in roots}
    together = {}
    for c in codes:
        together.setdefault(found.get(c, c), set()).add(c)
    expected = {}
    for c, _, least in classes([(c, c) for c in codes]):
        expected.setdefault(least, set()).add(c)
    assert sorted(map(sorted, together.values())) == sorted(map(sorted, expected.values()))


def test_dense_group_is_one_component():
    rng = np.random.default_rng(9)
    codes = np.unique(np.array([sum(1 << int(b) for b in rng.integers(0, 12, 4)) for _ in range(6000)], np.uint64))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    roots = simhash.linked_codes(codes, np.zeros(len(codes), np.int64), 3).root
    assert set(roots) == {0}


def test_gray_rank_is_the_place_in_the_gray_sequence():
    n = np.arange(5000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_chains_become_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(-5, -9), (-2, -5)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.connected(edges).collect()}
    assert {roots[i] for i in range(1, 201)} == {0} and roots[-2] == roots[-5] == -9


def test_one_of_each_component_stays(spark, odd_docs):
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    expected = {}
    for (doc, _, least), (_, text) in zip(classes([(i, plain_print(t)) for i, t in odd_texts()]), odd_texts()):
        expected.setdefault(least if least is not None else text, least)
    same_bag([r["doc_id"] for r in kept.collect()], list(expected.values()))
