import hashlib
import random

import numpy as np
import pytest
from cases import SF, odd_texts, same_bag

from eventlake.llm import edit_prints as ep
from eventlake.llm.queries import QUERIES


def embedded(text, walk):
    """The walk step by step: what is written at each step."""
    out, i, step, kinds = [], 0, 0, ep.kinds_of([text])[0].tolist()
    while i < len(kinds):
        out.append(kinds[i])
        ends = ep.STAYS[walk][kinds[i]][step & (ep.PERIOD - 1)] == 1  # the bit is set where a stay is one step
        i, step = i + bool(ends), step + 1
    return out


def plain_print(text):
    if not text:
        return bytes(ep.SLOTS)
    written = [embedded(text, w) for w in range(ep.WALKS)]
    return bytes(written[s % ep.WALKS][max(p for p in places if p < len(written[s % ep.WALKS]))] for s, places in enumerate(ep.SAMPLED))


def expected(docs):
    docs = [(i, t or "") for i, t in docs]
    ordered = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    out = []
    for (i, t), (_, follow) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + follow[:half]
        a, b, c = map(ep.fingerprint, (t, edited, follow))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), ep.likeness(a, b), ep.likeness(a, c)))
    return out


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "print", "edited_print", "near_edited", "near_next"]


def plain(rows):
    return [tuple(bytes(v).hex() if isinstance(v, (bytes, bytearray)) else v for v in r) for r in rows]


def test_fingerprint_samples_the_written_string():
    for _, text in odd_texts():
        if len(text or "") < 5000:
            assert ep.fingerprint(text) == plain_print(text)


def test_walks_side_by_side_are_the_walks_alone(monkeypatch):
    kinds = ep.kinds_of([(t or "")[:3000] for _, t in odd_texts()] * 3)
    starts = np.arange(len(kinds) * ep.WALKS).reshape(-1, ep.WALKS) * 7919
    alone = [ep._walk_alone(k, s) for k, s in zip(kinds, starts)]
    for cells, fewest in ((ep.CELLS, ep.FEWEST), (500, 1), (1, 1)):
        monkeypatch.setattr(ep, "CELLS", cells)
        monkeypatch.setattr(ep, "FEWEST", fewest)
        assert all((a == b).all() for a, b in zip(alone, ep.walk(kinds, starts)))


def test_edits_move_few_samples():
    rng = random.Random(2)
    near, apart = [], []
    for n in (60, 300, 3000):
        for _ in range(20):
            text = "".join(rng.choice("abcdefghij klmno") for _ in range(n))
            at = rng.randrange(n)
            changed = text[:at] + rng.choice(["", "x", "xyz"]) + text[at + rng.randrange(3):]
            near.append(ep.likeness(ep.fingerprint(text), ep.fingerprint(changed)))
            apart.append(ep.likeness(ep.fingerprint(text), ep.fingerprint("".join(rng.choice("abcdefghij klmno") for _ in range(n)))))
    assert np.mean(near) > 0.9 and np.max(apart) < 0.5 and np.mean(apart) < 0.25


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_next_document_over_partitions(spark, partitions):
    docs = [(i, t) for i, (_, t) in enumerate(odd_texts())] + [(-5, "the very first"), (1000, None), (None, "no id"), (999, "𝔘𝔫 last of all")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    same_bag(plain(ep.compare_in_order(rows, partitions).select(*COLUMNS).collect()), expected(docs))


def test_odd_rows(spark, odd_docs, no_docs):
    found = ep.fingerprints(odd_docs).collect()
    same_bag([(r["doc_id"], r["n_chars"], bytes(r["print"])) for r in found],
             [(i, len(t or ""), ep.fingerprint(t)) for i, t in odd_texts()])
    assert ep.fingerprints(no_docs).count() == 0
    one = spark.createDataFrame([(None, "only one")], "doc_id long, text string")
    assert plain(ep.compare_in_order(one).select(*COLUMNS).collect()) == expected([(None, "only one")])


def classes(prints, least):
    """All pairs within shared bands, linked where enough slots agree."""
    distinct, root = sorted(set(prints)), {}
    for i, a in enumerate(distinct):
        root.setdefault(a, a)
        for b in distinct[:i]:
            bands = any(a[k:k + ep.BAND] == b[k:k + ep.BAND] for k in range(0, ep.SLOTS, ep.BAND))
            if bands and ep.likeness(a, b) >= least:
                x, y = root[a], root[b]
                root = {k: (x if v == y else v) for k, v in root.items()}
    return root


def test_classes_join_near_texts_and_no_others(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(6):
        base = "".join(rng.choice("abcdefghij klmno") for _ in range(400))
        texts += [base, base] + [base[:k] + rng.choice(["", "zz", "Q"]) + base[k + 1:] for k in rng.sample(range(399), 12)]
    texts += ["same beginning of all the texts " * 3 + str(k) * 40 for k in range(25)]
    docs = [(100 - i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (7, ""), (8, None)]
    found = ep.fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    root = classes([ep.fingerprint(t) for _, t in docs], ep.LIKENESS)
    least = {}
    for i, t in docs:
        if i is not None:
            r = root[ep.fingerprint(t)]
            least[r] = min(i, least.get(r, i))
    same_bag([(r["doc_id"], r["near_id"]) for r in found], [(i, least[root[ep.fingerprint(t)]]) for i, t in docs])


def test_chunks_and_blocks_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(3)
    line = [rng.integers(1, 5, ep.SLOTS, dtype=np.uint8)]
    for k in range(400):  # a chain: each is near the one before, few are near the first
        line.append(line[-1].copy())
        line[-1][rng.integers(ep.BAND, ep.SLOTS, 9)] = rng.integers(5, 250)
        if k % 80 == 79:
            line[-1][ep.BAND:] = rng.integers(1, 250, ep.SLOTS - ep.BAND)
    prints = np.array(line)
    root = classes([p.tobytes() for p in prints], ep.LIKENESS)
    expected_sets = sorted(sorted(p for p in root if root[p] == r) for r in set(root.values()))
    monkeypatch.setattr(ep, "LEADERS", 2)
    monkeypatch.setattr(ep, "BLOCK", 8)
    found = ep.linked_prints(prints, 19)
    sets = sorted(sorted(set(prints[i].tobytes() for i in np.flatnonzero(found == r))) for r in set(found.tolist()))
    assert sets == expected_sets and len(sets) > 3
    rows = spark.createDataFrame([(i, p.tobytes()) for i, p in enumerate(prints)], "number long, print binary")
    for chunk_rows in (ep.CHUNK_ROWS, 40):
        roots = {r["node"]: r["root"] for r in ep.connected(ep.near_links(rows, chunk_rows=chunk_rows)).collect()}
        sets = {}
        for i, p in enumerate(prints):
            sets.setdefault(roots.get(i, i), set()).add(p.tobytes())
        assert sorted(map(sorted, sets.values())) == expected_sets


def test_query_against_brute_force(spark, given_docs):
    found = QUERIES["op13_edit_prints"](spark, SF)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows = found.select(*names).collect()
    same_bag([tuple(r) for r in rows], expected([(d["doc_id"], d["text"]) for d in given_docs]))
    long = [r for r in rows if r["n_chars"] > 100]
    assert np.mean([r["near_edited"] for r in long]) > 0.5 > 0.3 > np.mean([r["near_next"] for r in long])
