"""Near-duplicates, fingerprints and exact search against brute force."""

import os
import random
import re
import sys
from collections import Counter

from pyspark.sql import functions as F

from wayfare.llm import hamming, neardup
from wayfare.llm.hamming import search
from wayfare.llm.neardup import near_duplicates, one_of_each
from wayfare.llm.syncmers import DRIFT, anchors, compared, fingerprints, matches

sys.path.insert(0, os.path.dirname(__file__))
from brute_syncmers import brute  # noqa: E402
from brute_syncmers import x as xx  # noqa: E402

RNG = random.Random(7)
WORDS = ["alpha", "beta", "Gamma", "delta,", "eps", "zeta", "eta.", "theta", "iota", "kappa"]


def made_texts():
    base = [RNG.choice(WORDS) + str(RNG.randint(0, 30)) for _ in range(80)]
    near = []
    for _ in range(25):  # a group of near copies, some linked only through others
        copy = base[:]
        for _ in range(RNG.randint(1, 3)):
            copy[RNG.randrange(80)] = "new" + str(RNG.randint(0, 99))
        near.append(" ".join(copy))
    other = [" ".join(RNG.choices(WORDS, k=RNG.randint(0, 60))) for _ in range(20)]
    return [None, "", " \n ", "one", "One", "one two three", "x " * 30000, *near, *other, *near[:4], near[0].upper()]


def sets_of(text):
    words = [w for w in re.split("[\\x20\\x09-\\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plain_components(rows, percent=85):
    sets = {d: sets_of(t) for d, t in rows}
    root = {d: d for d in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return {d: (len(sets[d]), root[d], root[d] == d) for d in sets}


def test_near_duplicates(spark):
    rows = list(enumerate(made_texts()))
    RNG.shuffle(rows)
    docs = spark.createDataFrame([(d, t, "y", 1) for d, t in rows], "doc_id long, text string, cls string, n_shingles int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == plain_components(rows)
    assert near_duplicates(docs.limit(0)).count() == 0
    twice = near_duplicates(docs.where("doc_id = 5").union(docs.where("doc_id = 5"))).collect()
    assert [(r.component_id, r.kept) for r in twice] == [(5, True)] * 2
    stays = sorted(r.doc_id for r in one_of_each(docs.union(docs)).collect())
    assert stays == sorted(d for d, r in plain_components(rows).items() if r[2])


def test_near_duplicates_of_blank_texts_alone(spark):
    docs = spark.createDataFrame([(3, None), (2, ""), (1, " \n ")], "doc_id long, text string").repartition(3)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()} == {(d, 0, d, True) for d in (1, 2, 3)}
    assert one_of_each(docs).count() == 3


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 300)
    monkeypatch.setattr(neardup, "ROUNDS", 1)
    rows = list(enumerate(made_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == plain_components(rows)


def test_near_duplicates_at_other_thresholds(spark):
    """Copies of similarity 0.80 to 0.85 go at 80 and stay at 85, op5's own."""
    rng, rows = random.Random(3), []
    for k in range(40):
        words = [f"w{k}_{i}" for i in range(104)]
        copy = words[: 104 - rng.choice([16, 19, 20, 21, 24])]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = {d: sets_of(t) for d, t in rows}
    share = {d: len(sets[d] & sets[d + 1]) / len(sets[d] | sets[d + 1]) for d in range(0, 80, 2)}
    for percent, stays in ((85, one_of_each(docs)), (80, one_of_each(docs, 80))):
        want = {d for d, _ in rows if d % 2 == 0 or 100 * share[d - 1] < percent}
        assert {r.doc_id for r in stays.collect()} == want
    assert {0.8, 0.81} <= set(share.values()) and min(share.values()) < 0.8


def test_fingerprints(spark):
    rows = list(enumerate(made_texts()))
    docs = spark.createDataFrame([(d, t, "y") for d, t in rows], "doc_id long, text string, marks string").repartition(5)
    for parts in (1, 7, 100):
        got = {r.doc_id: tuple(r)[1:] for r in fingerprints(docs, parts).collect()}
        assert got == brute(rows)
    assert fingerprints(docs.limit(0), 4).count() == 0
    null = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), "text")
    assert fingerprints(docs.select("doc_id", "text").union(null), 4).count() == len(rows) + 1


def test_positional_matches(spark):
    shared = " ".join(f"w{i}" for i in range(40))
    row = spark.createDataFrame([("a b c " + shared, shared + " z")], "a string, b string").select(matches(anchors(F.col("a")), anchors(F.col("b"))).alias("m")).first()
    assert len(row.m) >= 10 and {p.a - p.b for p in row.m} == {3}


def test_repeated_anchors_match_in_order(spark):
    line = " ".join(f"w{i}" for i in range(12))
    row = spark.createDataFrame([(f"{line} {line} {line}", f"z {line} {line}")], "a string, b string").select(matches(anchors(F.col("a")), anchors(F.col("b"))).alias("m")).first()
    inside = [p for p in row.m if p.a % 12 < 9]
    assert {p.b - p.a for p in inside} == {1} and {p.a // 12 for p in inside} == {0, 1}


def test_long_texts_keep_all_anchors(spark):
    rng = random.Random(11)
    words = [[f"v{rng.randint(0, 10**6)}" for _ in range(n)] for n in (20000, 3000, 900)]
    words[1][500:560] = words[0][7000:7060]
    rows = [(9, " ".join(words[0])), (8, " ".join(words[1])), (7, " ".join(words[2] + words[2]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    places = {r.doc_id: [(a.at, a.hash) for a in r.a] for r in docs.select("doc_id", anchors(F.col("text")).alias("a")).collect()}
    sets = {d: {h for _, h in a} for d, a in places.items()}
    got = {r.doc_id: r for r in compared(docs, 2).collect()}
    for d, after in ((9, 8), (8, 7), (7, 9)):
        r = got[d]
        assert r.near_next == len(sets[d] & sets[after]) / len(sets[d] | sets[after])
        assert r.fingerprint == "".join(f"{h % (1 << 64):016x}" for h in sorted(sets[d]))
        at = {h: "+".join(str(a) for a, x in places[d] if x == h) for h in sorted(sets[d])} if d != 9 else None
        assert at is None or r.places == ",".join(at.values())
    assert got[9].near_next > 0 and got[9].matched_next >= 10 and got[9].near_edited > 0.4


def plain_compared(rows):
    """Likenesses of the query's fingerprints, from lists and counts."""

    def marks(text):
        words = [w.encode() for w in re.split("[\x20\x09-\x0D]+", text) if w]
        h = [xx(w) for w in words]
        if len(h) < 4:
            return [(0, xx(*h))] if h else []
        p = [xx(a, b) for a, b in zip(h, h[1:], strict=False)]
        return [(i, xx(p[i], p[i + 2])) for i in range(len(p) - 2) if min(p[i], p[i + 2]) <= p[i + 1]] or [(0, xx(*h))]

    def alike(a, b):
        first = [{}, {}]
        for side, m in enumerate((a, b)):
            for at, h in m:
                first[side].setdefault(h, at)
        steps = Counter((first[0][h] - first[1][h]) // DRIFT for h in first[0] if h in first[1])
        union = len({*first[0], *first[1]})
        return max((n + steps[k + 1] for k, n in steps.items()), default=0) / union if union else 1.0

    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text)
        edited = text[: n - n // 3] + after[: n // 3]
        out[doc] = (alike(marks(text), marks(edited)), alike(marks(text), marks(after)))
    return out


def test_likeness_by_places(spark):
    rows = list(enumerate(made_texts()))
    rng = random.Random(21)
    words = [f"p{rng.randint(0, 10**6)}" for _ in range(1200)]
    passages = [words[i : i + 200] for i in range(0, 1200, 200)]
    shuffled = [passages[i] for i in (4, 1, 5, 0, 3, 2)]
    for k, other in enumerate((words, sum(shuffled, []), words[:300] + ["new"] * 20 + words[300:], words[90:] + words[:90], [*words[:600], *words[:600]])):
        rows += [(1001 + 2 * k, " ".join(words)), (1000 + 2 * k, " ".join(other))]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, at int").repartition(5)
    got = {r.doc_id: (r.near_edited, r.near_next) for r in compared(docs, 6).collect()}
    want = plain_compared(rows)
    assert {d: tuple(round(x, 12) for x in v) for d, v in got.items()} == {d: tuple(round(x, 12) for x in v) for d, v in want.items()}
    same, mixed, longer, turned, half = (got[1001 + 2 * k][1] for k in range(5))
    assert same == 1.0 and mixed < 0.5 < turned < longer < same and half < same
    assert compared(docs.limit(0), 4).count() == 0


def test_four_words_have_an_anchor(spark):
    rows = [(k, f"a{k} b{k} c{k} d{k}") for k in range(60)] + [(60, " \n")]
    got = {r.doc_id: r for r in compared(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()}
    assert all(len(got[k].fingerprint) == 16 and got[k].places == "0" and got[k].near_next == 0 for k in range(60))
    assert (got[60].fingerprint, got[60].near_next) == ("", 0)


def test_exact_search(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(70)]) for i in range(300)]
    rows += [(i, rows[i % 3][1]) for i in range(300, 360)] + [(360, None), (None, rows[0][1]), rows[5], (361, [1.0] * 3)]
    vectors = spark.createDataFrame([(i, v, "e") for i, v in rows], "vec_id long, embedding array<float>, code string")
    got = {(r.query_id, r.rank): (r.vec_id, r.distance) for r in search(vectors, F.col("vec_id") % 50 == 0, 7).collect()}
    bits = {i: [x > 0 for x in v] + [False] * (70 - len(v)) for i, v in rows if i is not None and v is not None}
    want = {}
    for q in (i for i in bits if i % 50 == 0):
        near = sorted((sum(x != y for x, y in zip(bits[q], bits[i], strict=True)), i) for i in bits if i != q)[:7]
        want |= {(q, k + 1): (i, d) for k, (d, i) in enumerate(near)}
    assert got == want
    few = search(vectors.where("vec_id in (0, 50, 51)"), F.col("vec_id") == 0, 7).collect()
    assert sorted(r.vec_id for r in few) == [50, 51]
    assert search(vectors.limit(0), F.col("vec_id") == 0).count() == 0


def test_far_queries_are_compared_with_all_codes(spark, monkeypatch):
    rng, calls, plain = random.Random(9), [], hamming.scanned
    monkeypatch.setattr(hamming, "TOGETHER", 3)
    monkeypatch.setattr(hamming, "scanned", lambda *a: (calls.append(a[0].select("query").distinct().count()), plain(*a))[1])
    rows = [(i, [rng.gauss(0, 1) for _ in range(128)]) for i in range(200)]
    rows += [(200 + i, [x if rng.random() > 0.03 else -x for x in rows[i % 4][1]]) for i in range(100)]  # queries 0 and 100 have near ones, others have none
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.distance) for r in search(vectors, F.col("vec_id") % 20 == 0, 5).collect())
    bits = {i: [x > 0 for x in v] for i, v in rows}
    want = []
    for q in range(0, 300, 20):
        near = sorted((sum(x != y for x, y in zip(bits[q], bits[i], strict=True)), i) for i in bits if i != q)[:5]
        want += [(q, k + 1, i, d) for k, (d, i) in enumerate(near)]
    assert got == sorted(want)
    assert calls and 0 < calls[0] < 15
