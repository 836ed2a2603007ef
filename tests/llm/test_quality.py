"""Held-out accuracy and edge cases of the ordinal classifier."""

import math
import random

import numpy as np

from wayfare.llm.quality import Hasher, features, fit, grade_documents, sample_features, train

SF = "/root/testdata/sf0.01"


def test_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = fit(sample_features(docs, labels.where("doc_id % 3 != 0"), 6000))
    test = grade_documents(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    good = [r.kept for r in test if r.quality == 1 and r.toxic == 0]
    poor = [r.kept for r in test if r.quality == 0]
    assert sum(good) >= 0.95 * len(good) and sum(poor) <= 0.5 * len(poor)
    assert all(0 <= r.p_at_least_2 <= r.p_at_least_1 <= 1 for r in test)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 2), (2, "", 1), (None, "x " * 50000, 0), (2, "", 1)], "doc_id long, text string, grade int")
    assert [r.kept for r in grade_documents(docs, None).collect()] == [True] * 4
    model = train(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF, 300)
    assert grade_documents(docs, model).count() == 4
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fit(sample_features(docs, empty, 10)) is None
    assert grade_documents(docs.limit(0), model).count() == 0


def test_fit_is_a_minimum_and_scores_are_plain_sums(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["good", "fine", "poor", "bad", "so"][: 3 + k % 3], k=12)) for k in range(60)]
    grade = [min(2, t.count("good") // 3) for t in texts]
    hasher = Hasher()
    rows = [(*features(t, hasher), g) for t, g in zip(texts, grade, strict=True)]
    model = fit(rows, steps=3000, ridge=1e-3)

    def score(words, shape, m):
        return sum(float(m["words"][w]) for w in words) + float(shape @ m["shape"])

    def loss(m):
        out = 0.0
        for words, shape, g in rows:
            edges = [0.0, *(1 / (1 + math.exp(score(words, shape, m) - t)) for t in m["cuts"]), 1.0]
            out -= math.log(edges[g + 1] - edges[g])
        return out / len(rows) + 0.5e-3 * (sum(float(w) ** 2 for w in m["words"][m["words"] != 0]) + float(m["shape"] @ m["shape"]))

    least = loss(model)
    for w in hasher.values():
        for step in (-0.2, 0.2):
            moved = {**model, "words": model["words"].copy()}
            moved["words"][w] += step
            assert loss(moved) > least - 1e-4
    for k in range(2):
        for step in (-0.2, 0.2):
            assert loss({**model, "cuts": model["cuts"] + step * np.eye(2)[k]}) > least - 1e-4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in grade_documents(docs, model).collect():
        words, shape, _ = rows[r.doc_id]
        x = score(words, shape, model)
        tail = [1 / (1 + math.exp(t - x)) for t in model["cuts"]]
        assert abs(r.score - x) < 1e-6 and abs(r.expected_grade - sum(tail)) < 1e-6 and abs(r.p_at_least_2 - tail[1]) < 1e-6 and r.kept == (tail[1] >= 0.5)


def test_odd_labels(spark):
    """Labels twice, null and out of range; a tie of the sample's edge goes by id."""
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(6)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (1, None, 0), (2, 9, 0), (3, -4, 1), (None, 1, 0), (5, 1, None)], "doc_id long, quality int, toxic int")
    assert sorted(g for _, _, g in sample_features(docs, labels, 100)) == [0, 1, 2, 2]
    assert len(sample_features(docs, labels, 2)) == 2


def test_default_fit_has_the_least_loss(spark):
    """As many steps as a query takes lead to where ten times as many do."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = sample_features(docs, labels, 6000)

    def loss(m):
        out = 0.0
        for words, shape, g in rows:
            score = m["words"][words].sum(dtype=float) + shape @ m["shape"]
            edges = [0.0, *(1 / (1 + math.exp(score - t)) for t in m["cuts"]), 1.0]
            out -= math.log(edges[g + 1] - edges[g])
        return out / len(rows) + 1.5e-4 * ((m["words"].astype(float) ** 2).sum() + m["shape"] @ m["shape"])

    assert abs(loss(fit(rows)) - loss(fit(rows, steps=5000))) < 1e-5


def test_fit_without_a_grade():
    hasher = Hasher()
    for low, high in ((0, 1), (0, 2), (1, 2)):
        rows = [(*features(t, hasher), g) for t, g in [("poor bad thing", low), ("good fine thing", high)] * 20]
        model = fit(rows)
        assert model["cuts"][0] <= model["cuts"][1] and np.isfinite(model["words"]).all()
        for words, shape, g in rows:
            score = model["words"][words].sum() + shape @ model["shape"]
            tail = 1 / (1 + np.exp(model["cuts"] - score))
            assert sum(tail > 0.5) == g
