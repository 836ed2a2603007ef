"""Operator 13: alignment of two tokenizers' tokens by merge-path partitioning.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces) the text, to
which it adds that space itself; both cover the same bytes.  The ends of A's and of B's tokens
are two rising lists.  Binary searches along evenly spaced diagonals divide their merging into
pieces of ``PIECE`` steps, each independent of the others.  A piece emits an overlap for each
distinct end: there the A token and the B token that hold the byte before it overlap, and a
pair of tokens overlaps in one such stretch only.  An end that two pieces share is emitted by
the first.  Ends of both lists cut the tokens into groups; a group may begin in one piece and end
in a later one.

Words are encoded once per task and kept (``CACHE_WORDS``): a space between two other
characters begins a new word for both vocabularies.  Documents are gathered into chunks; what a
chunk must learn about its id pairs (in how many documents of the corpus each is linked, and
whether that is the highest of its A id) is a row per distinct pair of the chunk, never one per
link, and no table of pairs is broadcast.

A text that is null, empty, or whose joined A or B bytes are not the space and the text has
no tokens: zeros and an empty hash.  Texts are read whole; a document must fit a task's memory.
Repeated rows count as documents of their own.  Equal counts are all the highest.  An empty
table gives an empty one; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.bpe import byte_symbols
from wayfare.llm.classlm import looked_up, numbers
from wayfare.llm.common import documents, drop, store

#: Steps of a merge piece, links of a chunk, words that a task keeps.
PIECE, CHUNK_LINKS, CACHE_WORDS = 1 << 16, 2 << 20, 250_000
#: Bytes of text that are aligned together.
TOGETHER = 1 << 20
#: A space between two characters that are no white space.
BREAK = re.compile(r"(?<=\S) (?=\S)")
CHUNK = "chunk long, docs array<long>, counts array<int>, hashes array<string>, linked binary, pairs array<long>, held array<int>"
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def diagonal(a: np.ndarray, b: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """How many of the first ``steps`` of the merged ends are A's, by binary search on each diagonal; of equal ends A's is first."""
    lo, hi = np.maximum(steps - len(b), 0), np.minimum(steps, len(a))
    while (lo < hi).any():
        mid = (lo + hi) // 2
        # A's end number mid is among the first steps if it does not lie behind the B end opposite
        open_ = lo < hi
        i, j = np.where(open_, mid, 0), np.where(open_, steps - mid - 1, 0)
        among = a[np.minimum(i, len(a) - 1)] <= b[np.minimum(j, len(b) - 1)]
        lo, hi = np.where(open_ & among, mid + 1, lo), np.where(open_ & ~among, mid, hi)
    return lo


def merged_piece(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, A ends before it, B ends before it) for each step of a merge."""
    n = len(a) + len(b)
    from_a = np.arange(len(a)) + np.searchsorted(b, a, "left")
    is_a = np.zeros(n, bool)
    is_a[from_a] = True
    ends = np.empty(n, np.int64)
    ends[is_a], ends[~is_a] = a, b
    before = np.cumsum(is_a) - is_a
    return ends, before, np.arange(n) - before


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, whether both end there) of every overlap of two lists of rising ends that end alike."""
    n, piece = len(a) + len(b), piece or PIECE
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    steps = np.append(np.arange(0, n, piece), n)
    cut = diagonal(a, b, steps)
    out, last = [], -1
    for i, d, i2, d2 in zip(cut, steps, cut[1:], steps[1:], strict=False):
        ends, x, y = merged_piece(a[i:i2], b[d - i : d2 - i2])
        fresh = np.diff(ends, prepend=last) > 0
        last = ends[-1]
        x, y = i + x[fresh], d - i + y[fresh]
        out.append((x, y, a[x] == b[y]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


class Numbers(dict):
    """Word -> its number in ``order``; with ``plain``, -1 for a word with white space at an end, or none in it."""

    def __init__(self, order: list[str], plain: bool):
        self.order, self.plain = order, plain

    def __missing__(self, word: str) -> int:
        if self.plain and (not word or word[0].isspace() or word[-1].isspace()):
            at = -1
        else:
            at = len(self.order)
            self.order.append(word)
        self[word] = at
        return at


class Words:
    """Words with their A and B ids, which lie one after another, and the text of their groups."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        back = {s: i for i, s in enumerate(byte_symbols())}
        with open(a_path, encoding="utf-8") as f:
            special = {t["id"]: t["content"].encode() for t in json.load(f)["added_tokens"]}
        raw_a = [special.get(i) or bytes(back[c] for c in self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        raw_b = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace("▁", " ").encode() for n in names]
        self.raw = raw_a, raw_b
        self.sizes = tuple(np.array([len(x) for x in raw], np.int64) for raw in self.raw)
        self.wide = len(raw_b)
        #: A's ids before a comma and before a bar, B's before a comma and before a semicolon
        self.marked = [f"{i}{mark}".encode() for n, marks in ((len(raw_a), ",|"), (len(raw_b), ",;")) for mark in marks for i in range(n)]
        self.clear()

    def clear(self) -> None:
        self.order: list[str] = []
        self.plain, self.odd = Numbers(self.order, True), Numbers(self.order, False)
        self.flat = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.start = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.whole = np.zeros(0, bool)
        self.shown: list[bytes] = []

    def split(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words of all texts, and how many each text has."""
        found = []
        for text in texts:
            at = np.fromiter(map(self.plain.__getitem__, text.split(" ")), np.int64) if text else np.zeros(0, np.int64)
            if len(at) and at.min() < 0:
                at = np.fromiter(map(self.odd.__getitem__, BREAK.split(text)), np.int64)
            found.append(at)
        self.learn(self.order[len(self.whole) :])
        return np.concatenate(found), np.array([len(x) for x in found])

    def learn(self, words: list[str]) -> None:
        """Ids of new words, each with the space before it, and their groups, ``;`` after each."""
        if not words:
            return
        spaced = [" " + w for w in words]
        encoded = [[e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)], self.b.encode(words, num_threads=1)]
        ra, rb = self.raw
        same = [b"".join(map(ra.__getitem__, x)) == w.encode() == b"".join(map(rb.__getitem__, y)) for w, x, y in zip(spaced, *encoded, strict=True)]
        encoded = [[x if ok else () for x, ok in zip(ids, same, strict=True)] for ids in encoded]
        ids = [np.fromiter(chain.from_iterable(x), np.int64) for x in encoded]
        sizes = [np.fromiter(map(len, x), np.int64) for x in encoded]
        for side in (0, 1):
            self.flat[side] = np.concatenate([self.flat[side], ids[side]])
            self.start[side] = np.concatenate([self.start[side], self.start[side][-1] + np.cumsum(sizes[side])])
        self.whole = np.concatenate([self.whole, np.array(same, bool)])
        marked, z, order = self.marked.__getitem__, 0, self.grouped(*ids)
        for n in (sizes[0] + sizes[1]).tolist():
            self.shown.append(b"".join(map(marked, order[z : z + n])))
            z += n

    def ends(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        return [np.cumsum(size[x]) for size, x in zip(self.sizes, ids, strict=True)]

    def grouped(self, ids_a: np.ndarray, ids_b: np.ndarray) -> list[int]:
        """The tokens in the order of the groups' text, as places in ``marked``."""
        a, b, both = overlaps(*self.ends([ids_a, ids_b]))
        last_a, last_b = a[both], b[both]
        n_a, n_b = len(self.raw[0]), len(self.raw[1])
        out = np.empty(len(ids_a) + len(ids_b), np.int64)
        # before an A token stand the B tokens of the groups before its own; before a B token also the A tokens of its own
        before_a = np.concatenate([[0], last_b + 1])[np.searchsorted(last_a, np.arange(len(ids_a)), "left")]
        before_b = (last_a + 1)[np.searchsorted(last_b, np.arange(len(ids_b)), "left")]
        end_a, end_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        end_a[last_a], end_b[last_b] = n_a, n_b
        out[np.arange(len(ids_a)) + before_a] = ids_a + end_a
        out[np.arange(len(ids_b)) + before_b] = 2 * n_a + ids_b + end_b
        return out.tolist()

    def ids(self, side: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words ``at``, one after another, and how many each word has."""
        start = self.start[side]
        n = start[at + 1] - start[at]
        place = np.arange(n.sum()) + np.repeat(start[at] - (np.cumsum(n) - n), n)
        return self.flat[side][place], n


@lru_cache(1)
def words_of(a_path: str, b_path: str) -> Words:
    return Words(a_path, b_path)


def align(texts: list[str | None], words: Words) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(documents x (n_a, n_b, n_groups, n_links), group hashes, the document of each link, its id pair as a number)."""
    if len(words.order) > CACHE_WORDS:
        words.clear()
    at, n = words.split(texts)
    doc = np.repeat(np.arange(len(texts)), n)
    whole = np.bincount(doc, ~words.whole[at], len(texts)) == 0
    shown, hashes, z = words.shown.__getitem__, [], 0
    for size, ok in zip(n.tolist(), whole.tolist(), strict=True):
        hashes.append(hashlib.sha256(b"".join(map(shown, at[z : z + size].tolist()))[:-1]).hexdigest() if size and ok else "")
        z += size
    at, doc = at[whole[doc]], doc[whole[doc]]
    ids, sizes = zip(*(words.ids(side, at) for side in (0, 1)), strict=True)
    docs_of = [np.repeat(doc, s) for s in sizes]
    a, b, both = overlaps(*words.ends(ids))
    of = docs_of[0][a]
    counts = np.stack([np.bincount(d, minlength=len(texts)) for d in (*docs_of, of[both], of)], axis=1)
    return counts, hashes, of, ids[0][a] * words.wide + ids[1][b]


def chunks(docs: DataFrame, a_path: str, b_path: str, most: int) -> DataFrame:
    """Documents with their counts and hashes, links as numbers into the chunk's list of pairs, and how many of its documents hold each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, made = words_of(a_path, b_path), TaskContext.get().partitionId(), 0
        ids, counts, hashes, of, keys, links = [], [], [], [], [], 0

        def row() -> pa.RecordBatch:
            pairs, linked = np.unique(np.concatenate(keys), return_inverse=True)
            both = np.unique(np.concatenate(of) * len(pairs) + linked) if len(pairs) else np.zeros(0, np.int64)
            held = np.bincount(both % max(len(pairs), 1), minlength=len(pairs))
            planes = np.ascontiguousarray(linked.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
            values = [(part << 32) + made, ids, np.concatenate(counts).ravel().astype(np.int32), hashes, zstandard.compress(planes, 1), pairs, held.astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for b in batches:
            if not len(b):
                continue
            size = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(size // TOGETHER)) + 1).tolist(), len(b)]
            for a, z in zip(cuts, cuts[1:], strict=False):
                doc_ids, texts = (b.column(i).slice(a, z - a).to_pylist() for i in (0, 1))
                count, h, o, k = align(texts, words)
                of.append(o + len(ids))
                ids += doc_ids
                hashes += h
                counts.append(count)
                keys.append(k)
                links += len(k)
                if links >= most:
                    yield row()
                    made, links = made + 1, 0
                    ids, counts, hashes, of, keys = [], [], [], [], []
        if ids:
            yield row()

    names = ["chunk", "docs", "counts", "hashes", "linked", "pairs", "held"]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, CHUNK)


def pair_counts(chunk_table: DataFrame) -> DataFrame:
    """(word, n): in how many documents each id pair is linked."""
    return chunk_table.select(F.explode(F.arrays_zip("pairs", "held")).alias("x")).groupBy(F.col("x.pairs").alias("word")).agg(F.sum(F.col("x.held").cast("long")).alias("n"))


def with_best(counts: DataFrame, wide: int) -> DataFrame:
    """``best``: no other pair of the same A id is linked in more documents.  An A id has at most ``wide`` pairs."""
    each = counts.withColumn("a", F.expr(f"word div {wide}"))
    return each.join(each.groupBy("a").agg(F.max("n").alias("high")), "a").select("word", "n", (F.col("n") == F.col("high")).alias("best"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """One row per document, as the module says."""
    import sentencepiece

    wide = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    made = store(chunks(docs, a_path, b_path, chunk_links), "aligned")
    pairs = store(pair_counts(made), "pairs")
    known = looked_up(made.drop("held"), with_best(pairs, wide), ["n", "best"], by="pairs").drop("pairs")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                row = b.slice(i, 1)
                at = numbers(row.column("at"))
                count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
                count[at], best[at] = numbers(row.column("n")), numbers(row.column("best"))
                planes = np.frombuffer(zstandard.decompress(row.column("linked")[0].as_buffer()), np.uint8).reshape(4, -1)
                linked = np.ascontiguousarray(planes.T).view("<u4").ravel()
                own = numbers(row.column("counts")).reshape(-1, 4).astype(np.int64)
                end = np.cumsum(own[:, 3])
                sums = [np.concatenate([[0], np.cumsum(x[linked])]) for x in (best, count)]
                per = [s[end] - s[end - own[:, 3]] for s in sums]
                yield pa.RecordBatch.from_arrays([row.column("docs").flatten(), *map(pa.array, own.T.copy()), *map(pa.array, per), row.column("hashes").flatten()], names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    out = store(known.mapInArrow(run, SCHEMA), "alignment")
    drop(made, pairs)
    return out


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
