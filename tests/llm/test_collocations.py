"""Phrase collocations against counts by brute force, however words are dealt to buckets."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from wayfare.llm import collocations
from wayfare.llm.collocations import multikey


def counted(rows, most):
    """{lang: {words: count}} and {lang: number of words}."""
    found, total = {}, Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang or "und"] += len(words)
            for k in range(1, most + 1):
                found.setdefault(lang or "und", Counter()).update(zip(*(words[i:] for i in range(k)), strict=False))
    return found, total


def expected(rows, least=10, most=3, top=2000, inside=50):
    found, total = counted(rows, most)
    out = []
    for lang, f in found.items():
        phrases = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in phrases.items():
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [b for q, b in phrases.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= inside * a for b in longer):
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


@pytest.fixture
def rows():
    rng = random.Random(3)
    words = ["the", "of", "a", "Über", "日本", "x|y", "b", "cat", "SAT", "down", "é", "\x1f", "né"]
    weight = [30, 20, 15] + [3] * 10
    out = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choices(words, weight, k=rng.randint(0, 60))) + rng.choice([".", "\n", "! ", ""]) + "hot dog stand\tnow, hot dog") for _ in range(150)]
    return out + out[:9] + [("en", None), ("en", ""), (None, " .. ,\n"), ("fr", "tie one " * 12 + "tie two " * 12), ("fr", "lone " * 3000)]


@pytest.mark.parametrize(("bucket", "chunk", "hot"), [(1 << 20, 1 << 20, 500), (40, 300, 12), (64, 1 << 20, 1), (7, 50, 400)])
def test_equals_brute_force(spark, monkeypatch, rows, bucket, chunk, hot):
    for name, value in (("BUCKET", bucket), ("CHUNK", chunk), ("HOT", hot)):
        monkeypatch.setattr(collocations, name, value)
    docs = spark.createDataFrame([(lang, t, i, 0, 1) for i, (lang, t) in enumerate(rows)], "lang string, text string, doc_id long, phrase int, n int").repartition(5)
    got = collocations.collocations(docs)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == expected(rows)


@pytest.mark.parametrize(("least", "most", "top"), [(4, 2, 5), (6, 4, 50), (9, 6, 2000)])
def test_other_lengths(spark, rows, least, most, top):
    docs = spark.createDataFrame([(lang or "und", t) for lang, t in rows], "lang string, text string")
    assert sorted(tuple(r) for r in collocations.collocations(docs, least, most, top).collect()) == expected(rows, least, most, top)


def test_empty(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None), (None, "one")], "lang string, text string")).count() == 0


def test_counts_above_64_bits(spark):
    """a a 1,000,000 passes 64 bits from a = 3,100,000 on."""
    docs = spark.createDataFrame([("en", "so so " * 400_000)] * 4, "lang string, text string")
    assert [tuple(r) for r in collocations.collocations(docs, most=2).collect()] == [("en", 1, "so so", 3_199_996, 3_200_000, 3_200_000, 3_200_000, 1000000 * 3_199_996**2 // 3_200_000**2)]


def test_partitions_are_counts():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 9, 400, 5000):
        cols = rng.zipf(1.5, (3, size)) % 40
        cols[1][cols[0] == 0] = cols[2][(cols[0] == 0) | (cols[1] == 0)] = 0
        weight = rng.integers(1, 5, size)
        for need in ([1, 1, 1], [3, 3, 3], [1, 1, 8], [20, 20, 20]):
            at, length, heavy = multikey(cols, weight, need)
            got = {tuple(cols[:k, p].tolist()): w for p, k, w in zip(at.tolist(), length.tolist(), heavy.tolist(), strict=True)}
            want = Counter()
            for c, w in zip(cols.T.tolist(), weight.tolist(), strict=True):
                for k in (2, 3):
                    if all(c[:k]):
                        want[tuple(c[:k])] += w
            assert len(got) == len(at) and got == {p: w for p, w in want.items() if w >= need[len(p) - 1]}
