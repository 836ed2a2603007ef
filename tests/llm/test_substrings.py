"""Repeated strings against brute force, and the sort against sorted()."""

import hashlib
import random
from collections import Counter

from wayfare.llm.substrings import SEGMENT, remove_repeats
from wayfare.llm.suffixes import sorted_order


def brute(rows, length=400):
    seen = Counter(t[i : i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = []
    for doc, t in rows:
        mark = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        kept = bytes(c for c, m in zip(t, mark, strict=True) if not m)
        out.append((doc, len(t), len(t) - len(kept), sum(m and not (i and mark[i - 1]) for i, m in enumerate(mark)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeats(spark):
    rng = random.Random(11)
    text = lambda n: "".join(rng.choices("abcdé \n", k=n))
    shared = [text(n) for n in (390, 420, 700, 1500)]
    rows = [(0, None), (1, ""), (2, "short"), (3, "a" * 1200), (4, "ab" * 700), (5, text(399)), (6, text(2500)), (6, "other " + text(500))]
    for d in range(7, 40):  # passages in distinct surroundings, whole, cut short or edited
        p = rng.choice(shared)
        cut = rng.choice([0, 0, 5, 60])
        rows.append((d, text(rng.randint(0, 300)) + p[cut : len(p) - rng.choice([0, 3, 90])] + text(rng.randint(0, 300)) + rng.choice(["", shared[1], "a" * 500])))
    rows += [(40, rows[12][1]), (41, rows[12][1][:-1] + "!"), (42, rows[6][1] + rows[6][1]), rows[13], (None, rows[14][1])]
    docs = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, n int, key string").repartition(4)
    want = brute([(d, (t or "").encode()) for d, t in rows])
    for large in (20_000, 2):
        assert sorted(map(tuple, remove_repeats(docs, large=large).collect()), key=str) == want
    assert remove_repeats(docs.limit(0)).count() == 0
    both = remove_repeats(docs, passage=240).collect()
    assert sorted((tuple(r)[:5] for r in both), key=str) == want
    texts = [(d, (t or "").encode()) for d, t in rows]
    short = {d: spans for (d, _), spans in zip(texts, repeated_runs(texts, 240), strict=True)}
    for r in both:
        if r.doc_id not in (6, None):
            assert r.n_passages == sum(len(x) >= 400 or len(x.split()) > 50 for x in short[r.doc_id])


def repeated_runs(rows, length):
    seen = Counter(t[i : i + length] for _, t in rows for i in range(len(t) - length + 1))
    for _, t in rows:
        mark = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        ends = [0, *(i for i in range(1, len(t)) if mark[i] != mark[i - 1]), len(t)]
        yield [t[a:b] for a, b in zip(ends, ends[1:], strict=False) if b > a and mark[a]]


def test_across_segments(spark):
    """A passage over the seam of two segments of a text longer than one, and texts of one period."""
    rng = random.Random(5)
    noise = lambda n: bytes(rng.choices(range(97, 123), k=n)).decode()
    shared, long = noise(900), noise(2 * SEGMENT)
    seam = long[: SEGMENT - 450] + shared + long[SEGMENT - 450 :]
    docs = spark.createDataFrame([(1, seam), (2, noise(50) + shared), (3, "word " * 300_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeats(docs).collect()}
    assert [(got[d].n_removed, got[d].n_spans) for d in (1, 2, 3)] == [(900, 1), (900, 1), (1_500_000, 1)]
    assert got[1].kept_sha256 == hashlib.sha256(long.encode()).hexdigest()


def test_deep_shallow_order():
    rng = random.Random(3)
    items = [bytes(rng.choices(b"ab", k=rng.randint(0, 12))) for _ in range(200)]
    items += [b"x" * 64 + bytes(rng.choices(b"ab", k=rng.randint(0, 9))) + b"y" * rng.randint(0, 300) for _ in range(300)]
    items += items[:50] + items[-50:]
    assert [items[i] for i in sorted_order(items)] == sorted(items) and sorted(sorted_order(items)) == list(range(len(items)))
