import hashlib
from collections import Counter

import pytest
from cases import SF, odd_texts, same_bag

from eventlake.llm import alignment
from eventlake.llm.queries import QUERIES, tokenizer_path
from test_packing import SPACES

FILES = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
MORE = ["x▁y", "<s> a </s> <unk> <0x41>", "a<|endoftext|>b", "ﬁ Ａ ½ İ　x ​﻿ab é", "  lead and trail   ",
        "hello  world\n\n  x\t y", "x▁y", "café café café"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(FILES[0])
    made.encode_special_tokens = True
    return made, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def pieces(libraries, text):
    """(id, bytes) of both tokenizers, or nothing where the bytes differ from the text's."""
    one, two = libraries
    if not text:
        return [], []
    byte = {v: k for k, v in alignment.byte_of_sign().items()}
    sign = {s: b for b, s in byte.items()}
    a = [(i, bytes(sign[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode())
         for i in two.encode(text)]
    plain = (" " + text).encode()
    if b"".join(t for _, t in a) != plain or b"".join(t for _, t in b) != plain:
        return [], []
    return a, b


def brute(libraries, docs):
    """Byte by byte: which token of either side holds it, and where tokens of both end."""
    done = {}
    for text in {t for _, t in docs}:
        a, b = pieces(libraries, text)
        holds = [[k for k, (_, t) in enumerate(side) for _ in t] for side in (a, b)]
        ends = [{sum(len(t) for _, t in side[:k + 1]) for k in range(len(side))} if len(side) < 400 else
                {p for p in range(1, len(own) + 1) if p == len(own) or own[p] != own[p - 1]} for side, own in zip((a, b), holds)]
        both, groups, start = sorted(ends[0] & ends[1]), [], 0
        for end in both:
            groups.append("|".join(",".join(str(side[k][0]) for k in dict.fromkeys(own[start:end])) for side, own in zip((a, b), holds)))
            start = end
        links = [(a[i][0], b[j][0]) for i, j in dict.fromkeys(zip(*holds))]
        done[text] = len(a), len(b), len(groups), links, ";".join(groups)
    counts = Counter(link for _, text in docs for link in done[text][3])
    highest = {}
    for (_, b_id), n in counts.items():
        highest[b_id] = max(n, highest.get(b_id, 0))
    return [(doc_id, *done[t][:3], len(done[t][3]), sum(counts[l] == highest[l[1]] for l in done[t][3]), sum(counts[l] for l in done[t][3]),
             done[t][4]) for doc_id, t in docs]


def test_word_by_word_pieces_are_the_models(libraries, given_docs):
    texts = [d["text"] for d in given_docs] + SPACES + MORE + [t for _, t in odd_texts()]
    texts = [t for t in texts if t]
    made = alignment.PieceTokens(FILES[1])
    assert made.by_words
    assert [ids.tolist() for ids in made([" " + t for t in texts])] == [libraries[1].encode(t) for t in texts]
    made.by_words = False
    assert [ids.tolist() for ids in made([" " + t for t in texts[-40:]])] == [libraries[1].encode(t) for t in texts[-40:]]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 50, 0])
def test_odd_texts(spark, odd_docs, libraries, limit):
    docs = odd_docs.select("doc_id", "text", "score").union(spark.createDataFrame(
        [(200 + i, t, "x") for i, t in enumerate(MORE + SPACES)], "doc_id long, text string, score string"))
    aligned = alignment.align_texts(docs, *FILES)
    found = alignment.document_measures(docs, aligned, limit)
    same_bag([tuple(r) for r in found.collect()], brute(libraries, [(r["doc_id"], r["text"]) for r in docs.collect()]))


def test_small_groups_of_texts_give_the_same(monkeypatch, libraries):
    texts = [t for _, t in odd_texts() if t] + MORE
    made = alignment.aligner(*FILES)
    whole = made(texts, False)
    assert [repr(w) for w in whole] == [repr(made([t], False)[0]) for t in texts]
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    assert [repr(w) for w in whole] == [repr(w) for w in made(texts, False)]


def test_empty_tables(spark, no_docs):
    assert alignment.document_measures(no_docs, alignment.align_texts(no_docs, *FILES)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (None, "")], "doc_id long, text string")
    rows = alignment.document_measures(blank, alignment.align_texts(blank, *FILES)).collect()
    same_bag([tuple(r) for r in rows], [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, None)])


def test_query_against_brute_force(spark, given_docs, libraries):
    found = QUERIES["op12_aligned_tokens"](spark, SF)
    expected = brute(libraries, [(d["doc_id"], d["text"]) for d in given_docs])
    digest = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[1] else "") for r in expected]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    same_bag([tuple(r) for r in found.select(*names).collect()], digest)
