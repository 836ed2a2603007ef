"""Operator 11: language by a byte convolutional network.

A text is its UTF-8 bytes, cut into windows of ``WINDOW`` bytes, the last filled up with zero
bytes.  Filters of two, three and four bytes slide over the bytes, also across the ends of
windows within a text; each filter's maximum in a window, with a bias and cut off
at zero, feeds a softmax.  A text's log probabilities are the means of its windows',
weighted by their bytes, so every byte of a long text counts.  Zero bytes are padding
wherever they stand: their filter weights stay zero.

The network is trained in numpy with Adam and backpropagation through the maxima, on at most
``PER_LANG`` labelled texts of each language (those with the least hash of their id) and at
most ``SAMPLE`` in all, an equal number of each language; of a text on at most ``PIECES``
stretches, spread evenly.  These bounds hold for training only.  As filters see whole bytes, a filter is the sum of one table row per byte; two bytes
together have one row of a table of 65,536, built from the weights.

A null text, or one without a letter, is ``und`` with score 0; so is every text if no language
was learned.  Null ids belong to no fold: they are held out.  An id's repeated rows are predicted
once each.  Ties go to the language that sorts first.  An empty table gives an empty one.
Columns other than ``doc_id``, ``text`` and ``lang`` are ignored, and the last serves learning
only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.llm.common import documents

WIDTHS, FILTERS = (2, 3, 4), 16
WINDOW = 256
PER_LANG, SAMPLE, PIECES = 500, 20_000, 3
PAD = max(WIDTHS) - 1
#: Windows that are computed together; it does not change what comes out.
TOGETHER = 64
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def fold(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


# --- training -----------------------------------------------------------------------------


class Network:
    """``conv[w][j, byte, f]``: what byte j of a place adds to filter f of width w."""

    def __init__(self, langs: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        self.langs = langs
        self.conv = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        for table in self.conv.values():
            table[:, 0] = 0
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.1, (n, len(langs))).astype(np.float32)
        self.base = np.zeros(len(langs), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.conv.values(), self.bias, self.out, self.base]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[list[np.ndarray], float]:
        """Gradients of the mean cross-entropy, and that, for windows ``x`` (n, WINDOW + PAD) of classes ``y``."""
        n, top, at = len(x), [], []
        for w, table in self.conv.items():
            act = sum(table[j][x[:, j : j + WINDOW]] for j in range(w))
            at.append(act.argmax(1))
            top.append(np.take_along_axis(act, at[-1][:, None], 1)[:, 0])
        peak = np.concatenate(top, axis=1) + self.bias
        hidden = np.maximum(peak, 0)
        logits = hidden @ self.out + self.base
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        loss = -np.log(np.maximum(p[np.arange(n), y], 1e-12)).mean()
        p[np.arange(n), y] -= 1
        p /= n
        back = (p @ self.out.T) * (peak > 0)
        conv = []
        for k, (w, table) in enumerate(self.conv.items()):
            grad, mine = np.zeros_like(table), back[:, k * FILTERS : (k + 1) * FILTERS]
            for j in range(w):
                np.add.at(grad[j], (np.take_along_axis(x, at[k] + j, 1), np.arange(FILTERS)), mine)
            grad[:, 0] = 0
            conv.append(grad)
        return [*conv, back.sum(0), hidden.T @ p, p.sum(0)], float(loss)


def train(pieces: list[tuple[bytes, str]], epochs: int = 8, batch: int = 64, rate: float = 0.01, decay: float = 1e-4) -> Network | None:
    """Adam on balanced, shuffled windows; a third of them are cut short, so that short texts are learned too."""
    langs = sorted({lang for _, lang in pieces})
    if not langs:
        return None
    net, rng = Network(langs), np.random.default_rng(1)
    x = np.zeros((len(pieces), WINDOW + PAD), np.uint8)
    for i, (piece, _) in enumerate(pieces):
        x[i, : min(len(piece), WINDOW + PAD)] = np.frombuffer(piece[: WINDOW + PAD], np.uint8)
    y = np.array([langs.index(lang) for _, lang in pieces])
    by_class = [np.flatnonzero(y == k) for k in range(len(langs))]
    most = max(map(len, by_class))
    params = net.parameters()
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, steps = 0, epochs * max(1, -(-most * len(langs) // batch))
    for _ in range(epochs):
        order = rng.permutation(np.concatenate([np.resize(rng.permutation(c), most) for c in by_class]))
        for a in range(0, len(order), batch):
            at = order[a : a + batch]
            xs = x[at]
            for i in np.flatnonzero(rng.random(len(at)) < 1 / 3):
                n = rng.integers(8, 100)
                xs[i, :n], xs[i, n:] = np.roll(xs[i], -int(rng.integers(0, WINDOW // 2)))[:n].copy(), 0
            grads, _ = net.gradients(xs, y[at])
            step += 1
            now = rate * (1 - step / (steps + 1))
            for p, g, mm, vv in zip(params, grads, m, v, strict=True):
                mm += 0.1 * (g - mm)
                vv += 0.01 * (g * g - vv)
                p -= now * (mm / (1 - 0.9**step) / (np.sqrt(vv / (1 - 0.99**step)) + 1e-8) + decay * p)
    return net


def stretches(text: bytes, most: int = PIECES) -> list[bytes]:
    """At most ``most`` windows of a text, spread evenly."""
    n = max(1, min(most, -(-len(text) // WINDOW)))
    last = max(0, len(text) - WINDOW)
    return [text[(s := last * i // max(1, n - 1)) : s + WINDOW + PAD] for i in range(n)]


def labelled_pieces(docs: DataFrame, per_lang: int, sample: int) -> list[tuple[bytes, str]]:
    """Training stretches of the sampled texts; never of the held-out fold.  The sample's ids are few enough to broadcast."""
    rows = docs.where((fold() != 1) & F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    ranked = rows.select("doc_id", "lang", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")).alias("n"))
    ids = ranked.where(F.col("n") <= per_lang).orderBy("n", "lang").limit(sample).select("doc_id", "lang").distinct()
    picked = rows.join(F.broadcast(ids), ["doc_id", "lang"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(d, lang, i, p) for d, text, lang in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True) for i, p in enumerate(stretches(text.as_buffer().to_pybytes()))]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate((b.schema.field(0).type, pa.string(), pa.int32(), pa.binary()))], ["doc_id", "lang", "i", "piece"])

    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, i int, piece binary"
    got = picked.select("doc_id", "text", "lang").mapInArrow(run, kinds).dropDuplicates(["doc_id", "lang", "i"]).collect()
    return [(bytes(r.piece), r.lang) for r in sorted(got, key=lambda r: (r.lang, r.doc_id, r.i))]


# --- prediction ---------------------------------------------------------------------------


class Predictor:
    """The network with tables for two bytes at a time."""

    def __init__(self, net: Network):
        self.net = net
        two = lambda a, b: (a[:, None] + b[None]).reshape(1 << 16, FILTERS)
        self.tables = []
        for w, table in net.conv.items():
            steps = [(j, two(table[j], table[j + 1])) for j in range(0, w - 1, 2)]
            self.tables.append((steps, table[w - 1] if w % 2 else None, w - 1))

    def windows(self, flat: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log probabilities of the windows of ``flat``; what follows a text's ``last`` window is not its own."""
        n = len(last)
        rows = np.lib.stride_tricks.as_strided(flat, (n, WINDOW + PAD), (WINDOW, 1)).copy()
        rows[last, WINDOW:] = 0
        out = np.empty((n, len(self.net.langs)), np.float32)
        for a in range(0, n, TOGETHER):
            x = rows[a : a + TOGETHER].astype(np.intp)
            pairs, top = (x[:, :-1] << 8) + x[:, 1:], []
            for steps, single, at in self.tables:
                act = np.take(steps[0][1], pairs[:, :WINDOW], axis=0)
                for j, table in steps[1:]:
                    act += np.take(table, pairs[:, j : j + WINDOW], axis=0)
                if single is not None:
                    act += np.take(single, x[:, at : at + WINDOW], axis=0)
                top.append(act.max(1))
            logits = np.maximum(np.concatenate(top, axis=1) + self.net.bias, 0) @ self.net.out + self.net.base
            logits -= logits.max(1, keepdims=True)
            out[a : a + TOGETHER] = logits - np.log(np.exp(logits).sum(1, keepdims=True))
        return out

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): softmax of the byte-weighted mean log probabilities of a text's windows."""
        counts = np.array([-(-len(t) // WINDOW) for t in texts])
        flat = np.zeros(counts.sum() * WINDOW + PAD, np.uint8)
        starts = np.cumsum(counts) - counts
        sizes = np.array([len(t) for t in texts])
        for text, s in zip(texts, (starts * WINDOW).tolist(), strict=True):
            flat[s : s + len(text)] = np.frombuffer(text, np.uint8)
        of = np.repeat(np.arange(len(texts)), counts)
        filled = np.clip(sizes[of] - (np.arange(len(of)) - starts[of]) * WINDOW, 0, WINDOW)
        last = np.zeros(len(of), bool)
        last[starts + counts - 1] = True
        mean = np.add.reduceat(self.windows(flat, last) * filled[:, None], starts, axis=0) / sizes[:, None]
        p = np.exp(mean - mean.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, from its text alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Predictor(net) if net else None
        for b in batches:
            pred, score, at, texts, size = ["und"] * len(b), np.zeros(len(b)), [], [], 0

            def flush() -> None:
                if texts:
                    p = model.probabilities(texts)
                    for i, k, s in zip(at, p.argmax(1).tolist(), p.max(1).tolist(), strict=True):
                        pred[i], score[i] = net.langs[k], s
                at.clear()
                texts.clear()

            for i, text in enumerate(b.column(1)):
                if model and text.is_valid and any(map(str.isalpha, text.as_py())):
                    at.append(i)
                    texts.append(text.as_buffer().to_pybytes())
                    size += len(texts[-1])
                    if size > 1 << 22:
                        flush()
                        size = 0
            flush()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(fold() == 1, F.lit(True)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held).mapInArrow(run, SCHEMA)


def learn(docs: DataFrame, per_lang: int = PER_LANG, sample: int = SAMPLE) -> Network | None:
    return train(labelled_pieces(docs, per_lang, sample))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, learn(docs))
