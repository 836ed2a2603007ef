"""The network against plain sums, its gradients against differences, and held-out accuracy."""

import zlib

import numpy as np
import pytest

from wayfare.llm import language
from wayfare.llm.language import PAD, WIDTHS, WINDOW, Network, Predictor

ROWS = "doc_id long, text string, lang string, held_out int, score int"


def plain(net, text):
    """Log probabilities of the windows of a text, filter by filter and place by place."""
    n = -(-len(text) // WINDOW)
    data = text + bytes(n * WINDOW + PAD - len(text))
    out, weight = [], []
    for i in range(n):
        top = []
        for w in WIDTHS:
            places = [sum(net.conv[w][j, data[i * WINDOW + t + j]].astype(float) for j in range(w)) for t in range(WINDOW)]
            top += list(np.max(places, axis=0))
        z = np.maximum(np.array(top) + net.bias, 0) @ net.out + net.base
        out.append(z - np.log(np.exp(z).sum()))
        weight.append(min(WINDOW, max(0, len(text) - i * WINDOW)))
    p = np.exp(np.average(out, axis=0, weights=weight))
    return p / p.sum()


def test_prediction_is_the_network():
    net, rng = Network(["a", "b", "c"], 5), np.random.default_rng(2)
    net.bias += rng.normal(0, 0.2, len(net.bias)).astype(np.float32)
    texts = ["é".encode(), b"ab", bytes(rng.integers(1, 256, WINDOW - PAD, np.uint8)), bytes(rng.integers(1, 256, WINDOW, np.uint8)), bytes(rng.integers(0, 256, 3 * WINDOW - 1, np.uint8))]
    got = Predictor(net).probabilities(texts)
    assert np.allclose(got, [plain(net, t) for t in texts], atol=1e-5)
    assert np.allclose(Predictor(net).probabilities(texts[::-1]), got[::-1], atol=1e-6)


def test_gradients():
    net, rng = Network(["a", "b", "c"], 3), np.random.default_rng(4)
    for p in net.parameters():
        p += rng.normal(0, 0.1, p.shape).astype(np.float32)
    for table in net.conv.values():
        table[:, 0] = 0
    net.conv = {w: t.astype(float) for w, t in net.conv.items()}
    net.bias, net.out, net.base = (x.astype(float) for x in (net.bias, net.out, net.base))
    x, y = rng.integers(0, 20, (5, WINDOW + PAD)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    grads, _ = net.gradients(x, y)
    for p, g in zip(net.parameters(), grads, strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        before, losses = p[at], []
        for d in (1e-5, -1e-5):
            p[at] = before + d
            losses.append(net.gradients(x, y)[1])
        p[at] = before
        assert abs((losses[0] - losses[1]) / 2e-5 - g[at]) < 1e-4 * max(1, abs(g[at]))
    assert all((g[:, 0] == 0).all() for g in grads[: len(WIDTHS)])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")


def test_held_out_accuracy(spark, docs):
    rows = {r.doc_id: r for r in docs.collect()}
    got = language.op11_language(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == rows[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_labels_of_the_held_out_fold_are_not_read(spark, docs):
    """Nor are source and id inputs: other values, other rows around, same predictions."""
    held = "crc32(cast(cast(doc_id as string) as binary)) % 3 = 1"
    few = docs.where("doc_id < 300")
    changed = few.selectExpr("doc_id", "text", f"case when {held} then 'xx' else lang end lang", "1 source").repartition(7)
    nets = [language.learn(d, per_lang=20) for d in (few, changed)]
    assert nets[0].langs == nets[1].langs == ["de", "en", "es", "fr"]
    assert all((a == b).all() for a, b in zip(nets[0].parameters(), nets[1].parameters(), strict=True))
    rows = [{r.doc_id: (r.lang_pred, r.score) for r in language.predict(d, nets[0]).collect()} for d in (few, changed.where("doc_id % 2 = 0").selectExpr("doc_id", "text"))]
    assert all(rows[0][k][0] == v[0] and abs(rows[0][k][1] - v[1]) < 1e-6 for k, v in rows[1].items())


def test_edges(spark):
    en, fr = "the cat sat on the mat and then ", "le chat était sur la natte où "
    rows = [(i, (en if i % 2 else fr) * (1 + i % 5), "en" if i % 2 else "fr", 7, 7) for i in range(60)]
    odd = [(100, None, "en", 1, 1), (101, "", "en", 1, 1), (102, "12 ½ ² _ !", "en", 1, 1), (None, fr, "en", 1, 1), (103, fr * 20_000, None, 1, 1), (104, "\x00" * 5 + en, None, 1, 1), (105, "Ж", None, 1, 1), rows[3], rows[3]]
    docs = spark.createDataFrame(rows + odd, ROWS).repartition(4)
    got = language.predict(docs, language.learn(docs)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0) for i in (100, 101, 102))
    assert by[None].held_out and by[None].lang_pred == "fr" and by[103].lang_pred == "fr" and by[104].lang_pred == "en"
    assert by[105].lang_pred in ("en", "fr") and by[105].score >= 0.5
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 3}) == 1
    assert sum(r.lang_pred == ("en" if r.doc_id % 2 else "fr") for r in got if r.doc_id is not None and r.doc_id < 60) >= 60


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b", None, 0, 0), (2, None, "en", 0, 0)], ROWS)
    assert {(r.lang_pred, r.score) for r in language.predict(docs, language.learn(docs)).collect()} == {("und", 0.0)}
    empty = docs.limit(0)
    assert language.predict(empty, language.learn(empty)).count() == 0


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "word " * 400, f"l{i % 7}", 0, 0) for i in range(200)], ROWS)
    assert len({lang for _, lang in language.labelled_pieces(docs, 50, 9)}) == 7
    assert len(language.labelled_pieces(docs, 50, 9)) == 9 * language.PIECES
    assert len(language.labelled_pieces(docs, 2, 1000)) == 14 * language.PIECES
