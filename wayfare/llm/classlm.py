"""Operator 7: Brown class-based bigrams, with classes found by exchange clustering.

Documents are gathered into chunks of some ``CHUNK_BYTES`` of text, each with its own
numbered word list, so that what a chunk tells of its words is one row per distinct
word of the chunk and never one per token, and no table of all words is ever broadcast.
A word's row keeps its places (chunk, number there), so that its class and count go
back to the chunks without a look-up, packed by chunk.

Classes start from a word's ending.  In each exchange round every training word
gathers the classes before and after it from all training documents; tasks hold the
round's class-pair counts (``CLASSES`` squared numbers) and move each word to the class
that raises the class bigram likelihood most.  All words of a round move against the
same counts, so classes do not depend on how words are dealt to tasks.  The first round
goes by the words themselves and numbers them.  Unseen words keep their ending's class.  The model's probability of a token is
P(class | class before) * P(word | class), both smoothed by additive constants;
each class also has mass for one unseen word.

Null text counts as empty: one token, the end.  A null id belongs to no fold; it is
scored, counted as held out and not learned from.  Repeated rows are learned and
scored once each; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import LOWER_AZ, documents, drop, store

CLASSES, ROUNDS = 32, 2
CHUNK_BYTES = 16 << 20
#: Words that a task works on at a time; it does not change what comes out.
TOGETHER = 1024
#: Places that a task deals to their chunks at a time, more or less.
DEALT = 1 << 20
#: The end of a document; no word holds a line break.  Its class is its own.
END = b"\n"
ALPHA = 0.1
_WIDE = CLASSES + 1
CHUNK = "chunk long, docs array<long>, held array<boolean>, lengths array<int>, tokens binary, first binary, pairs array<long>, words array<binary>"
#: A class before a word (after it: plus _WIDE), and how often.
SIDE = np.dtype([("side", "u1"), ("n", "<u4")])
#: A chunk that has a word, and the word's number there.
PLACE = np.dtype([("chunk", "<i8"), ("at", "<i4")])
#: What a chunk is told of a word.
KNOWN = np.dtype([("at", "<i4"), ("cls", "u1"), ("value", "<i8")])
AROUND = ["word", "chunk", "at", "cls", "around"]


def first_class(word: bytes) -> int:
    return CLASSES if word == END else zlib.crc32(word[-2:]) % CLASSES


@cache
def tails() -> tuple[np.ndarray, np.ndarray]:
    """First classes by a word's only byte, and by its last two."""
    return tuple(np.array([first_class(n.to_bytes(size)) for n in range(256**size)], np.uint8) for size in (1, 2))


def first_classes(words: pa.Array) -> np.ndarray:
    ends, data = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1], np.frombuffer(words.buffers()[2], np.uint8)
    last = data[ends[1:] - 1].astype(np.int64)
    one, two = tails()
    return np.where(np.diff(ends) == 1, one[last], two[last + 256 * data[np.maximum(ends[1:] - 2, 0)].astype(np.int64)])


class Numbers(dict):
    """Word -> its number in the order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def chunks(docs: DataFrame, most: int = CHUNK_BYTES) -> DataFrame:
    """Tokens of many documents as numbers into the chunk's word list, with the words' first classes and the counts of their pairs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        number, ids, held, tokens, size = Numbers(), [], [], [], 0
        number[END]

        def row() -> pa.RecordBatch:
            lengths = np.array([len(t) for t in tokens], np.int32)
            flat, words = np.concatenate(tokens), pa.array(list(number), pa.binary())
            planes = np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 4).T).tobytes()
            first = first_classes(words)
            now = first[flat].astype(np.int32)
            pairs = paired(before_of(now, np.cumsum(lengths) - lengths), now, np.repeat(~np.array(held), lengths))
            values = [(part << 32) + made, ids, held, lengths, zstandard.compress(planes, 1), first.tobytes(), pairs]
            columns = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)], names)

        for b in batches:
            for doc, text, out in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                words = text.as_buffer().to_pybytes().translate(LOWER_AZ).split() if text.is_valid else []
                words.append(END)
                ids.append(doc)
                held.append(out)
                tokens.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                size += 8 * len(words) + (len(text.as_buffer()) if text.is_valid else 0) // 2
                if size >= most:
                    yield row()
                    made, size = made + 1, 0
                    number, ids, held, tokens = Numbers(), [], [], []
                    number[END]
        if ids:
            yield row()

    names = ["chunk", "docs", "held", "lengths", "tokens", "first", "pairs", "words"]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(True))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held")).mapInArrow(run, CHUNK)


def numbers(column: pa.Array) -> np.ndarray:
    """A one-row list column's values; none for a null list."""
    return column.flatten().to_numpy(zero_copy_only=False)


def unpacked(row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's tokens, its documents' first places, and which tokens are learned from."""
    lengths = numbers(row.column("lengths"))
    planes = np.frombuffer(zstandard.decompress(row.column("tokens")[0].as_buffer()), np.uint8).reshape(4, -1)
    flat = np.ascontiguousarray(planes.T).view(np.int32).ravel()
    return flat, np.cumsum(lengths) - lengths, np.repeat(~numbers(row.column("held")), lengths)


def before_of(cls: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.concatenate([np.full(1, CLASSES, cls.dtype), cls[:-1]])
    out[starts] = CLASSES
    return out


def paired(before: np.ndarray, now: np.ndarray, learned: np.ndarray) -> np.ndarray:
    return np.bincount(before[learned] * _WIDE + now[learned], minlength=_WIDE * _WIDE)


def packed(rows: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values: the bytes of ``rows`` between neighbouring bounds."""
    offsets = (bounds * rows.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def unpack(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All rows in a column of packed ones, and how many each value has."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data if data else b"", np.uint8)[ends[0] : ends[-1]].view(kind), np.diff(ends) // kind.itemsize


def looked_up(chunk_table: DataFrame, table: DataFrame, fields: list[str], by: str = "words", *, by_id: bool = False) -> DataFrame:
    """Chunks with ``at`` (places in the list ``by``) and ``fields``, for what ``table`` has as ``word``: the list's values, or their ids."""
    words = chunk_table.select("chunk", F.posexplode(by).alias("at", "word"))
    if by_id:
        words = words.withColumn("word", F.xxhash64("word"))
    found = words.join(table.hint("shuffle_hash"), "word").groupBy("chunk").agg(F.collect_list(F.struct("at", *fields)).alias("known"))
    return chunk_table.join(found, "chunk", "left").withColumns({c: F.col(f"known.{c}") for c in ["at", *fields]}).drop("known")


def dealt(chunk_table: DataFrame, moved: DataFrame, value: str) -> DataFrame:
    """Chunks with ``known``: the class and ``value`` of each word of ``moved`` that they have, in pieces as they were dealt."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> pa.RecordBatch:
            chunk, rows = np.concatenate(into), np.concatenate(found)
            order = np.argsort(chunk, kind="stable")
            chunk = chunk[order]
            first = np.flatnonzero(np.diff(chunk, prepend=chunk[0] - 1))
            return pa.RecordBatch.from_arrays([pa.array(chunk[first]), packed(rows[order], np.append(first, len(chunk)))], ["chunk", "known"])

        into, found, size = [], [], 0
        for b in batches:
            places, many = unpack(b.column("places"), PLACE)
            rows = np.empty(len(places), KNOWN)
            rows["at"] = places["at"]
            rows["cls"], rows["value"] = (np.repeat(b.column(c).to_numpy(), many) for c in ("cls", "value"))
            into.append(places["chunk"])
            found.append(rows)
            size += len(rows)
            if size >= DEALT:
                yield pieces()
                into, found, size = [], [], 0
        if size:
            yield pieces()

    known = moved.select("cls", F.col(value).alias("value"), "places").mapInArrow(run, "chunk long, known binary")
    return chunk_table.join(known.groupBy("chunk").agg(F.collect_list("known").alias("known")), "chunk", "left")


def told(row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's classes by word, with those that it was dealt, and what it was dealt."""
    known, _ = unpack(row.column("known").flatten(), KNOWN)
    cls = np.frombuffer(row.column("first")[0].as_buffer(), np.uint8).astype(np.int32)
    cls[known["at"]] = known["cls"]
    return cls, known


def surroundings(flat: np.ndarray, before: np.ndarray, now: np.ndarray, learned: np.ndarray, at: np.ndarray, size: int) -> pa.Array:
    """For each word of ``at``, the classes before and after it in what is learned from, packed; none for a word of other documents."""
    which = np.full(size, -1, np.int32)
    which[at] = np.arange(len(at), dtype=np.int32)
    word = which[flat]
    place = np.flatnonzero(learned & (word >= 0))  # a word never ends a document: the end does
    row_of = word[place].astype(np.int32 if len(at) * 2 * _WIDE < 1 << 31 else np.int64) * np.int32(2 * _WIDE)
    cell, n = np.unique(np.concatenate([row_of + before[place], row_of + _WIDE + now[place + 1]]), return_counts=True)
    cells = np.empty(len(cell), SIDE)
    cells["side"], cells["n"] = cell % (2 * _WIDE), n
    return packed(cells, np.searchsorted(cell, (np.arange(len(at) + 1) * 2 * _WIDE).astype(cell.dtype)))


def in_slices(columns: list[pa.Array], names: list[str], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(columns, names)
    yield from (whole.slice(k, rows) for k in range(0, len(whole), rows))


def entries(chunk_table: DataFrame) -> DataFrame:
    """Every word but the end of each chunk, as itself, with what stands around it at the words' first classes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                row = b.slice(i, 1)
                flat, starts, learned = unpacked(row)
                cls = np.frombuffer(row.column("first")[0].as_buffer(), np.uint8).astype(np.int32)
                now, at = cls[flat], np.arange(1, len(cls), dtype=np.int32)
                around = surroundings(flat, before_of(now, starts), now, learned, at, len(cls))
                chunk = np.full(len(at), row.column("chunk")[0].as_py(), np.int64)
                yield from in_slices([row.column("words").flatten().slice(1), pa.array(chunk), pa.array(at), pa.array(cls[1:]), around], AROUND)

    wanted = chunk_table.select("chunk", "held", "lengths", "tokens", "words", "first")
    return wanted.mapInArrow(run, "word binary, chunk long, at int, cls int, around binary")


def gathered(chunk_table: DataFrame, moved: DataFrame, words_too: bool) -> DataFrame:
    """Class-pair counts of each chunk, and what stands around each word of ``moved``, by its number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                row = b.slice(i, 1)
                flat, starts, learned = unpacked(row)
                cls, known = told(row)
                now = cls[flat]
                before = before_of(now, starts)
                pairs = pa.array([paired(before, now, learned)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.nulls(1, k) for k in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())] + [pairs], [*AROUND, "pairs"])
                if words_too and len(known):
                    at = np.ascontiguousarray(known["at"])
                    around = surroundings(flat, before, now, learned, at, len(cls))
                    chunk = np.full(len(at), row.column("chunk")[0].as_py(), np.int64)
                    yield from in_slices([pa.array(np.ascontiguousarray(known["value"])), pa.array(chunk), pa.array(at), pa.array(cls[at]), around, pa.nulls(len(at), pa.list_(pa.int64()))], [*AROUND, "pairs"])

    wanted = dealt(chunk_table.select("chunk", "held", "lengths", "tokens", "first"), moved, "word")
    return store(wanted.mapInArrow(run, "word long, chunk long, at int, cls int, around binary, pairs array<long>"), "around")


def pair_counts(found: DataFrame) -> np.ndarray:
    """The class-pair counts of all chunks: CLASSES + 1 squared numbers."""
    out = np.zeros(_WIDE * _WIDE)
    for r in found.where("pairs is not null").select(F.posexplode("pairs").alias("cell", "n")).groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out.reshape(_WIDE, _WIDE)


def xlogx(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0)
    return x * np.log(np.maximum(x, 1e-9))


def moves(n: np.ndarray, old: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The class to which each word, taken out of its own, adds most class bigram likelihood.

    ``before`` and ``after`` count the classes around each word; ``n`` holds all class pairs.
    """
    gain = np.zeros((len(old), CLASSES))
    classes = np.arange(CLASSES)
    for pairs, around, other in ((n, after, before), (n.T, before, after)):
        # pairs[c, d]: a word of class c would stand next to class d; only classes around the word count
        word, d = np.nonzero(around)
        out_of = old[word]
        rest = pairs[:CLASSES, d].T - (classes == out_of[:, None]) * around[word, d][:, None] - (d == out_of)[:, None] * other[word, :CLASSES]
        rows, first = np.unique(word, return_index=True)
        if len(rows):
            gain[rows] += np.add.reduceat(xlogx(rest + around[word, d][:, None]) - xlogx(rest), first)
        total = pairs.sum(1)[:CLASSES] - (classes == old[:, None]) * around.sum(1)[:, None] - other[:, :CLASSES]
        gain -= xlogx(total + around.sum(1)[:, None]) - xlogx(total)
    return np.argmax(gain, axis=1)


def exchanged(found: DataFrame, pairs: np.ndarray | None) -> DataFrame:
    """Training words as (word, cls, c, places): number, class after the best move (without ``pairs``, as it was), training count, places.

    ``found`` has the words themselves, which are then numbered, or their numbers.
    """

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Sorted rows as (words, their classes, counts of the classes around them, their numbers of places, the places); a word comes once."""
        held = None
        for b in batches:
            if not len(b):
                continue
            coded = b.column("word").dictionary_encode()
            which, words = coded.indices.to_numpy(), coded.dictionary
            cells, lengths = unpack(b.column("around"), SIDE)
            around = np.bincount(np.repeat(which.astype(np.int64), lengths) * 2 * _WIDE + cells["side"], cells["n"], len(words) * 2 * _WIDE).astype(float, copy=False).reshape(-1, 2 * _WIDE)
            many = np.bincount(which, minlength=len(words))
            old = b.column("cls").to_numpy()[np.cumsum(many) - many]
            places = np.empty(len(b), PLACE)
            places["chunk"], places["at"] = b.column("chunk").to_numpy(), b.column("at").to_numpy()
            if held and held[0].equals(words.slice(0, 1)):
                around[0] += held[2][0]
                many[0] += held[3][0]
                places = np.concatenate([held[4], places])
            elif held:
                yield held
            cut = len(places) - many[-1]
            if len(words) > 1:
                yield words.slice(0, len(words) - 1), old[:-1], around[:-1], many[:-1], places[:cut]
            held = words.slice(len(words) - 1), old[-1:], around[-1:], many[-1:], places[cut:]
        if held:
            yield held

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for words, old, around, many, places in merged(batches):
            c = around[:, :_WIDE].sum(1).astype(np.int64)
            some = c > 0  # the others are in held-out documents only
            if not some.any():
                continue
            places, old, around, many, n = places[np.repeat(some, many)], old[some], around[some], many[some], int(some.sum())
            new = old
            if pairs is not None:
                new = np.concatenate([moves(pairs, old[k : k + TOGETHER], around[k : k + TOGETHER, :_WIDE], around[k : k + TOGETHER, _WIDE:]) for k in range(0, n, TOGETHER)])
            numbered = words.filter(pa.array(some)) if words.type == pa.int64() else pa.array(np.arange(number, number + n))
            number += n
            yield pa.RecordBatch.from_arrays([numbered, pa.array(new, pa.int32()), pa.array(c[some]), packed(places, np.append(0, np.cumsum(many)))], ["word", "cls", "c", "places"])

    words = found.where("word is not null").select(*AROUND).repartition("word").sortWithinPartitions("word")
    return store(words.mapInArrow(run, "word long, cls int, c long, places binary"), "moved")


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    chunk_table = store(chunks(docs), "chunks")
    pairs = pair_counts(chunk_table)
    moved = exchanged(entries(chunk_table), pairs if rounds else None)
    for k in range(rounds):
        found = gathered(chunk_table, moved, k + 1 < rounds)
        pairs = pair_counts(found)
        if k + 1 < rounds:
            old, moved = moved, exchanged(found, pairs)
            drop(old)
        drop(found)
    sizes, kinds = np.zeros(_WIDE), np.zeros(_WIDE)
    for r in moved.groupBy("cls").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        sizes[r.cls], kinds[r.cls] = r.c, r.n
    ends = int(pairs[:, CLASSES].sum())
    sizes[CLASSES], kinds[CLASSES] = ends, ends > 0
    total, distinct = int(sizes.sum()), int(kinds.sum())
    step = np.log10(pairs + ALPHA) - np.log10(pairs.sum(1, keepdims=True) + ALPHA * _WIDE)
    spread = np.log10(sizes + ALPHA * (kinds + 1))
    base_spread = math.log10(total + ALPHA * (distinct + 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                row = b.slice(i, 1)
                flat, starts, _ = unpacked(row)
                cls, known = told(row)
                c = np.zeros(len(cls), np.int64)
                c[known["at"]], c[0] = known["value"], ends  # a chunk's first word is the end
                log_c, now = np.log10(c + ALPHA), cls[flat]
                own = np.add.reduceat(log_c[flat], starts)
                n = numbers(row.column("lengths")).astype(np.int64)
                score = own + np.add.reduceat(step[before_of(now, starts), now] - spread[now], starts)
                seen = np.add.reduceat((c > 0).astype(np.int64)[flat], starts)
                yield pa.RecordBatch.from_arrays([row.column("docs").flatten(), row.column("held").flatten(), pa.array(n), pa.array(seen), pa.array([total] * len(n), pa.int64()), pa.array(own - n * base_spread), pa.array(score)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    wanted = dealt(chunk_table.select("chunk", "docs", "held", "lengths", "tokens", "first"), moved, "c")
    return wanted.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op7_classlm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
