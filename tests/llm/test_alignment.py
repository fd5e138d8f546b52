"""Token alignment against plain Python over all pairs of tokens of small texts."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("tastegrid.llm.queries")

from tastegrid.llm import alignment, incidence  # noqa: E402
from tastegrid.llm.queries import tokenizer_file  # noqa: E402
from tastegrid.session import local_session  # noqa: E402

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SCHEMA = "doc_id long, text string, pairs string, n_a int, _key string"
TEXTS = [(0, None), (1, ""), (2, " "), (3, "a  b \n\t c"), (4, "é　z🙂 日本語"), (5, "<|endoftext|> <s> <0x41>"),
         (6, "a▁b gives other bytes"), (7, "The quick brown foxes; misspelt wrods 12345 "), (8, "The quick brown foxes"),
         (8, "the same id, another text"), (None, "no id"), (9, "The quick brown foxes"), (9, "The quick brown foxes"),
         (10, "word " * 3000), (11, "x" * 5000), (12, "é é \x00 \x7f")]


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


def expected():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_file(A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(B))
    from tastegrid.llm.byte_bpe import byte_letters
    letters = byte_letters()
    rows, corpus = [], Counter()
    for doc, text in TEXTS:
        text = text or ""
        ia = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        sa = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
        sb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
              for i in ib]
        if not (b"".join(sa) == b"".join(sb) == (" " + text).encode()):
            ia, ib, sa, sb = [], [], [], []
        ends = [np.cumsum([len(x) for x in s]).astype(int).tolist() for s in (sa, sb)]
        spans = [[(e - len(x), e) for e, x in zip(end, s)] for end, s in zip(ends, (sa, sb))]
        links = [(x, y) for x, (s, e) in zip(ia, spans[0]) for y, (t, f) in zip(ib, spans[1]) if s < f and t < e]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        parts, low, shared = [], 0, 0
        for cut in cuts:
            of = [[i for i, e in zip(ids, end) if low < e <= cut] for ids, end in ((ia, ends[0]), (ib, ends[1]))]
            parts.append("|".join(",".join(map(str, ids)) for ids in of))
            shared += len(of[0]) * len(of[1])
            low = cut
        corpus.update(links)
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        rows.append((doc, len(ia), len(ib), len(cuts), links, digest, shared))
    most: dict = {}
    for (x, y), n in corpus.items():
        most[y] = max(most.get(y, 0), n)
    return [(d, a, b, g, len(ls), sum(corpus[p] == most[p[1]] for p in ls), sum(corpus[p] for p in ls), h, s)
            for d, a, b, g, ls, h, s in rows]


@pytest.mark.parametrize("hot_pairs", [alignment.HOT_PAIRS, 40, 1])
def test_alignment(spark, hot_pairs):
    docs = spark.createDataFrame([(d, t, "p", 1, "k") for d, t in TEXTS], SCHEMA).repartition(3)
    got = alignment.aligned_documents(docs, tokenizer_file(A), tokenizer_file(B), hot_pairs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[7])
    assert sorted(map(tuple, got), key=key) == sorted(expected(), key=key)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert alignment.aligned_documents(none, tokenizer_file(A), tokenizer_file(B)).count() == 0


def test_products():
    rng = np.random.default_rng(1)
    for _ in range(20):
        dense = [(rng.random(s) < .3).astype(int) for s in ((5, 7), (7, 4))]
        left, right = (incidence.Csr(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1], m.shape[1]) for m in dense)
        row, column, value = incidence.product(left, right)
        want = dense[0] @ dense[1]
        got = np.zeros_like(want)
        got[row, column] = value
        assert (got == want).all() and len(row) == (want > 0).sum()
        assert incidence.product_sizes(left, right).tolist() == want.sum(1).tolist()
        back = right.transposed().transposed()
        assert back.indices.tolist() == right.indices.tolist() and back.indptr.tolist() == right.indptr.tolist()


def test_shared_group_links():
    found = alignment.linked(np.array([1, 3, 4, 6]), np.array([2, 4, 5, 6]))
    assert found.groups.tolist() == [4, 6]
    assert list(zip(found.row, found.column, found.shared)) == [(0, 0, 1), (1, 0, 1), (1, 1, 1), (2, 1, 1), (3, 2, 1), (3, 3, 1)]
    row, column = alignment.shared_group_links(found)
    assert list(zip(row, column)) == [(i, j) for i in range(3) for j in range(2)] + [(3, 2), (3, 3)]
    assert found.mates.tolist() == [2, 2, 2, 2]
