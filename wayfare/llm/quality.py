"""Operator 10: ordinal cumulative-link regression on graded ratings.

A document's grade is its quality label plus one if it is not toxic: 0, 1 or 2.
One weight vector over hashed words and a few shape features is shared by all
grades; ordered thresholds cut its score:  P(grade <= k) = sigmoid(t_k - score).
The model gives the expected grade and the tail probability P(grade >= 2), by
which documents are selected.

The fit uses a bounded sample (``sample`` labelled documents, the smallest by a
hash of their id); scoring covers every document and whole texts.  Null text
counts as empty.  A document labelled several times takes its lowest grade.
With no usable label at all, every document is kept and its scores are null.
Repeated rows are scored once each; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import documents, slices

BITS = 18
SAMPLE = 6000
WORD = re.compile(r"[^\W\d_]+")
SCHEMA = "doc_id long, score double, expected_grade double, p_at_least_1 double, p_at_least_2 double, kept boolean"
SHAPES = 9
MARKS = "!#$%&*+<=>@[\\]^_`{|}~"


class Hasher(dict):
    """Word -> bucket of its hash; the first SHAPES buckets are kept for shape features."""

    def __missing__(self, word: str) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = out = SHAPES + zlib.crc32(word.encode()) % ((1 << BITS) - SHAPES)
        return out


def features(text: str, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct words, and the shape features: shares of capitals,
    marks, bars, digits, repeated words and lines, runs of one word, and the log of the length."""
    stretches = text.split()
    n = max(len(stretches), 1)
    distinct = set(stretches)
    words = {w.lower() for s in distinct for w in WORD.findall(s)}
    lines = [x for x in text.split("\n") if x]
    size = max(len(text), 1)
    plain = WORD.sub("", text)
    upper = sum(s.isupper() and len(s) > 1 for s in stretches) / n
    marks = sum(map(plain.count, MARKS)) / size
    bars = stretches.count("|") / n
    digits = sum(map(plain.count, "0123456789")) / size
    runs = sum(a == b for a, b in zip(stretches, stretches[1:], strict=False)) / n
    shape = np.array([float(not words), upper, min(marks * 10, 1.0), min(bars * 4, 1.0), min(digits * 5, 1.0), 1 - len(distinct) / n, 1 - len(set(lines)) / max(len(lines), 1), min(runs * 4, 1.0), np.log1p(n) / 10])
    return np.fromiter(map(hasher.__getitem__, words), np.int64, len(words)), shape


def least(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, kept: int = 10) -> np.ndarray:
    """Where a smooth loss, given with its gradient, is least: L-BFGS, each step halved until the loss falls."""
    (now, grad), past = loss(x), []
    for _ in range(steps):
        if np.abs(grad).max() < 1e-6:
            break
        move, along = -grad, []
        for s, g in reversed(past):
            along.append(s @ move / (s @ g))
            move = move - along[-1] * g
        move = move * (past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else min(1.0, 1 / np.abs(grad).sum()))
        for (s, g), a in zip(past, reversed(along), strict=True):
            move = move + (a - g @ move / (s @ g)) * s
        size = 1.0
        while (found := loss(x + size * move))[0] > now + 1e-4 * size * (grad @ move) and size > 1e-9:
            size /= 2
        if found[0] >= now:
            break
        s, g = size * move, found[1] - grad
        if s @ g > 1e-12:
            past = [*past, (s, g)][-kept:]
        x, (now, grad) = x + s, found
    return x


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], grades: int = 3, steps: int = 500, ridge: float = 3e-4, least_share: int | None = None) -> dict | None:
    """The least ordinal log loss with a ridge, by at most ``steps`` steps of L-BFGS.

    Every word of the sample gets a weight, which only the ridge holds; with ``least_share`` only those
    that one in so many sampled documents has.
    """
    if len({g for _, _, g in rows}) < 2:
        return None
    seen = np.zeros(1 << BITS, np.int32)
    for words, _, _ in rows:
        seen[np.unique(words)] += 1
    kept = np.flatnonzero(seen >= (1 if least_share is None else max(3, len(rows) // least_share)))
    column = np.full(1 << BITS, -1, np.int32)
    column[kept] = np.arange(len(kept))
    cols = [c[c >= 0] for c in (column[w] for w, _, _ in rows)]
    doc = np.repeat(np.arange(len(rows)), [len(c) for c in cols])
    col = np.concatenate(cols) if cols else np.zeros(0, np.int32)
    shape = np.stack([s for _, s, _ in rows])
    y = np.array([g for _, _, g in rows])
    n, d = len(rows), len(kept) + SHAPES
    share = [np.clip((y <= k).mean(), 1e-3, 1 - 1e-3) for k in range(grades - 1)]
    cut = np.log(share) - np.log1p(-np.array(share))
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -35, 35)))

    def cuts(x: np.ndarray) -> np.ndarray:
        """The first threshold, and each later one by the logarithm of what it adds: they stay in order."""
        return np.cumsum(np.append(x[d], np.exp(np.clip(x[d + 1 :], -20, 20))))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, cut = x[:d], cuts(x)
        score = np.bincount(doc, w[SHAPES + col], n) + shape @ w[:SHAPES]
        edges = np.column_stack([np.zeros(n), *(sig(c - score) for c in cut), np.ones(n)])
        hi, lo = edges[np.arange(n), y + 1], edges[np.arange(n), y]
        p = np.maximum(hi - lo, 1e-9)
        up, down = hi * (1 - hi) / p, lo * (1 - lo) / p
        by_score = up - down  # of the loss, per unit of score
        by_word = np.concatenate([shape.T @ by_score, np.bincount(col, by_score[doc], len(kept))]) / n + ridge * w
        by_cut = np.array([(down[y == k + 1].sum() - up[y == k].sum()) / n for k in range(grades - 1)])
        by_cut = np.cumsum(by_cut[::-1])[::-1] * np.append(1, np.diff(cut))
        return -np.log(p).mean() + ridge / 2 * (w @ w), np.concatenate([by_word, by_cut])

    x = least(loss, np.concatenate([np.zeros(d), cut[:1], np.log(np.maximum(np.diff(cut), 1e-3))]), steps)
    w, cut = x[:d], cuts(x)
    weights = np.zeros(1 << BITS, np.float32)
    weights[kept] = w[SHAPES:]
    return {"words": weights, "shape": w[:SHAPES], "cuts": cut}


def sample_features(docs: DataFrame, labels: DataFrame, sample: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Features of at most ``sample`` labelled documents; the sample's ids are few enough to broadcast."""
    grade = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(F.col("quality") + 1 - F.coalesce("toxic", F.lit(0))).cast("int").alias("grade"))
    picked = grade.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "grade").dropDuplicates(["doc_id"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            found = [features(t, hasher) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0].astype("<i4").tobytes() for f in found], pa.binary()), pa.array([f[1].tobytes() for f in found], pa.binary()), b.column(2), b.column(0)], ["words", "shape", "grade", "doc_id"])

    got = rows.mapInArrow(run, "words binary, shape binary, grade int, doc_id long").collect()
    return [(np.frombuffer(r.words, "<i4"), np.frombuffer(r.shape), max(0, min(2, r.grade))) for r in sorted(got, key=lambda r: r.doc_id)]


def tails(texts: Iterable[pa.Scalar], model: dict, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Each text's score, and its probabilities of grade 1 or more and of grade 2."""
    scores = []
    for text in texts:
        words, shape = features(text.as_py() or "", hasher)
        scores.append(model["words"][words].sum(dtype=float) + shape @ model["shape"])
    score = np.array(scores, float)
    return score, 1 / (1 + np.exp(np.clip(model["cuts"][:, None] - score, -35, 35)))


def select_good(docs: DataFrame, model: dict | None, least: float = 0.5) -> DataFrame:
    """The documents whose P(grade >= 2) is at least ``least``, all columns; all of them without a model."""
    place = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in slices(batches):
            yield b.filter(pa.array(tails(b.column(place), model, hasher)[1][1] >= least))

    return docs if model is None else docs.mapInArrow(run, docs.schema)


def grade_documents(docs: DataFrame, model: dict | None, least: float = 0.5) -> DataFrame:
    """Score, expected grade and tail probabilities of every document; kept if P(grade >= 2) >= ``least``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            if model is None:
                none = pa.nulls(len(b), pa.float64())
                yield pa.RecordBatch.from_arrays([b.column(0), none, none, none, none, pa.array([True] * len(b))], names)
                continue
            score, tail = tails(b.column(1), model, hasher)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, (score, tail.sum(0), tail[0], tail[1], tail[1] >= least))], names)

    names = ["doc_id", "score", "expected_grade", "p_at_least_1", "p_at_least_2", "kept"]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def train(spark: SparkSession, docs: DataFrame, sf_dir: str, sample: int = SAMPLE, least_share: int | None = None) -> dict | None:
    return fit(sample_features(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), sample), least_share=least_share)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return grade_documents(docs, train(spark, docs, sf_dir))
