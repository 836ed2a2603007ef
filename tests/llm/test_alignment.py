"""Token alignment against a plain walk over both tokenizers' own output."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest

from wayfare.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  a  b", "a▁b", "a▁ b", "x\n y  z \t q", "<|endoftext|> <s> </s> <unk>", "Ｆｕｌｌ ﬁ ½ é é \xa0 x　y", "\x00 a\x1f b", "'s 've don't", "日本語 テキスト 😀😀 a", "a" * 3000, "  lead", "trail  ", "one", "one", "\n", "end \n", "é" * 700 + " the"]


@pytest.fixture(scope="module")
def words():
    return alignment.Words(A, B)


def tokens(words, text):
    if not text:
        return [], []
    a, b = words.a.encode(" " + text, add_special_tokens=False).ids, words.b.encode(text)
    spaced = (" " + text).encode()
    raw = [b"".join(r[i] for i in ids) for r, ids in zip(words.raw, (a, b), strict=True)]
    return (a, b) if raw == [spaced, spaced] else ([], [])


def walked(words, text):
    """Ids, links (pairs of ids) and the text of groups: all pairs of tokens in turn."""
    ids = tokens(words, text)
    ends = [list(accumulate(len(r[i]) for i in x)) for r, x in zip(words.raw, ids, strict=True)]
    links, groups, i, j, first = [], [], 0, 0, (0, 0)
    while i < len(ids[0]):
        links.append((ids[0][i], ids[1][j]))
        x, y = ends[0][i], ends[1][j]
        i, j = i + (x <= y), j + (y <= x)
        if x == y:
            groups.append("|".join(",".join(map(str, t[a:z])) for t, a, z in zip(ids, first, (i, j), strict=True)))
            first = (i, j)
    return (*ids, links, groups)


def expected(words, rows):
    found = [(d, *walked(words, t)) for d, t in rows]
    held = Counter(pair for f in found for pair in set(f[3]))
    high = {}
    for (a, _), n in held.items():
        high[a] = max(n, high.get(a, 0))
    return sorted((d or -1, len(a), len(b), len(g), len(links), sum(held[p] == high[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for d, a, b, links, g in found)


@pytest.fixture(scope="module")
def rows(spark):
    got = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 120").collect()]
    return got + [(5000 + i, t) for i, t in enumerate(ODD)] + [got[3], (None, "no id"), (6000, "tie ties " * 500 + got[5][1])]


@pytest.mark.parametrize(("links", "piece", "kept"), [(1 << 20, 1 << 16, 600_000), (900, 7, 40), (1, 64, 0)])
def test_equals_a_plain_walk(spark, monkeypatch, words, rows, links, piece, kept):
    monkeypatch.setattr(alignment, "PIECE", piece)
    monkeypatch.setattr(alignment, "CACHE_WORDS", kept)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n long, chunk string").repartition(5)
    got = alignment.align_documents(docs, A, B, links)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((r.doc_id or -1, *r[1:]) for r in got.collect()) == expected(words, rows)


def test_empty(spark):
    assert alignment.align_documents(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
    got = alignment.align_documents(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_pieces_of_a_merge():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 60)
        a, b = (np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n})) for _ in range(2))
        want = [(int(np.searchsorted(a, e)), int(np.searchsorted(b, e)), e in a and e in b) for e in sorted({*a.tolist(), *b.tolist()})]
        for piece in (1, 2, 5, 64):
            assert [(int(x), int(y), bool(z)) for x, y, z in zip(*alignment.overlaps(a, b, piece), strict=True)] == want
        steps = np.arange(0, len(a) + len(b) + 1)
        merged = sorted([(e, 0) for e in a] + [(e, 1) for e in b])
        assert alignment.diagonal(a, b, steps).tolist() == [sum(side == 0 for _, side in merged[:d]) for d in steps]


def test_looked_up_by_any_list(spark):
    """The class model's look-up, by words, their ids, or another list of a chunk; unknown values and empty lists have no row."""
    chunks = spark.createDataFrame([(1, ["a", "b", "c"], [30, 10]), (2, ["c"], [20, 30, 40]), (3, [], [])], "chunk long, words array<string>, pairs array<long>")
    by_pair = spark.createDataFrame([(10, 1), (20, 2), (30, 3)], "word long, n long")
    by_word = spark.createDataFrame([("a", 1), ("c", 3)], "word string, n long")

    def found(*args, **kwargs):
        return {r.chunk: sorted(zip(r.at or [], r.n or [], strict=True)) for r in alignment.looked_up(chunks, *args, **kwargs).collect()}

    assert found(by_pair, ["n"], by="pairs") == {1: [(0, 3), (1, 1)], 2: [(0, 2), (1, 3)], 3: []}
    assert found(by_word, ["n"]) == {1: [(0, 1), (2, 3)], 2: [(0, 3)], 3: []}
    assert found(by_word.selectExpr("xxhash64(word) word", "n"), ["n"], by_id=True) == {1: [(0, 1), (2, 3)], 2: [(0, 3)], 3: []}


def test_registered_query(spark, words):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((r.doc_id or -1, *r[1:]) for r in alignment.op13_alignment(spark, sf).collect()) == expected(words, rows)
