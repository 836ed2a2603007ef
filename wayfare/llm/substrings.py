"""Operator 8: exact removal of repeated byte strings, by sorting around anchors.

Each 400-byte window has one anchor, the place of its least k-gram hash; equal
windows have equal anchors at equal distances.  A document's windows fall into
runs of one anchor.  A run is cut into two parts: the windows that hold more than
half of their bytes left of the anchor, and the others.  All windows of a part
share that half of a window, whose hash is the part's group: equal windows lie in
parts of one group, and an anchor that is frequent only as a line or phrase does
not make a group.

Parts with equal bytes are repeated as a whole, which aggregation tells.  A part
that is alone is compared with the other classes of its group: their right parts,
and their left parts backwards, are put in suffix order (multikey quicksort to a
shallow depth, blind tries below it); neighbours' common prefixes then tell which
of its windows occur again.

A group with more than ``LARGE`` classes never goes to one task: its classes'
windows (half a window's length of them at most) are counted by hash over all
tasks instead, with the same result.  Parts that repeat within a document, as in
periodic text, leave it as one row and a span.  Equal texts are repeated whole,
which their count tells.  Tables are deleted after their last reader.

Null text counts as empty; texts under 400 bytes lose nothing.  Matches never cross
documents; a repeated row repeats all of its windows.  Documents are told apart by
id and text, so equal ids do no harm; other columns are ignored.  An empty table
gives an empty one.  Long texts are read in segments of 1 MB, and what a task holds
of a document's places is bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import documents, drop, store
from wayfare.llm.suffixes import common, sorted_order

LENGTH, GRAM = 400, 32
#: Passages: repeated runs, of strings of so many bytes, with more than so many words.
PASSAGE_BYTES, PASSAGE_WORDS = 240, 50
LARGE = 4_000
SEGMENT = (1 << 20) - 1024
#: Places of a document that a task holds at a time.
TOGETHER = 4_000
#: ``group`` is null for a span that repeats within its document: ``lo`` is its start, ``hi`` its end.
PARTS = "doc_id long, text_hash long, group long, ctx long, lo int, hi int, at int"
_P = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def raw(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def runs_of(text: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int]]:
    """(first window, last window, anchor) for every run of windows with one anchor."""
    for base in range(0, max(len(text) - length + 1, 0), SEGMENT):
        b = np.frombuffer(text[base : base + SEGMENT + length - 1], np.uint8)
        h, size, power = b.astype(np.uint64) + np.uint64(1), 1, _P
        while size < gram:
            h = h[:-size] * np.uint64(power) + h[size:]
            power, size = power * power % (1 << 64), size * 2
        h = (h ^ (h >> np.uint64(32))) * _MIX
        h ^= h >> np.uint64(29)
        m = (h >> np.uint64(20) << np.uint64(20)) | np.arange(len(h), dtype=np.uint64)
        span, size = length - gram + 1, 1
        while 2 * size <= span:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        m = np.minimum(m[: len(b) - length + 1], m[span - size : span - size + len(b) - length + 1])
        first = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
        last = np.concatenate([first[1:], [len(m)]]) - 1
        at = (m[first] & np.uint64((1 << 20) - 1)).astype(np.int64)
        yield from zip((first + base).tolist(), (last + base).tolist(), (at + base).tolist(), strict=True)


def parts_of(text: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int, int, int]]:
    """(group, ctx, first window, last window, anchor) of every part."""
    half, digest = (length - GRAM) // 2, xxhash.xxh3_64_intdigest
    for lo, hi, at in runs_of(text, length):
        mid = at - half  # the first window with at most ``half`` bytes left of the anchor
        if lo < mid:
            last = min(hi, mid - 1)
            yield digest(text[mid - 1 : at + GRAM]) - (1 << 63), digest(text[lo : last + length], at - lo) - (1 << 63), lo, last, at
        if hi >= mid:
            first = max(lo, mid)
            yield digest(text[at : mid + length], 1) - (1 << 63), digest(text[first : hi + length], at - first) - (1 << 63), first, hi, at


def joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one, ascending."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_parts(docs: DataFrame, length: int = LENGTH, among: DataFrame | None = None) -> DataFrame:
    names = ["doc_id", "text_hash", "group", "ctx", "lo", "hi", "at"]
    kinds = [pa.int64()] * 4 + [pa.int32()] * 3

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for b in batches:
            for doc, text, th in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                text = raw(text)
                seen: dict[tuple[int, int], tuple | None] = {}
                again = []
                for group, ctx, lo, hi, at in parts_of(text, length):
                    if (group, ctx) not in seen:
                        seen[group, ctx] = (lo, hi)
                        rows.append((doc, th, group, ctx, lo, hi, at))
                        if len(rows) > 50_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows = []
                    else:
                        if first := seen[group, ctx]:
                            again.append((first[0], first[1] + length))
                            seen[group, ctx] = None
                        again.append((lo, hi + length))
                        if len(again) > 10_000:
                            again = joined(again)
                rows += [(doc, th, None, None, start, end, None) for start, end in joined(again)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    texts = keyed(docs) if among is None else on_doc(keyed(docs), among, "left_semi")
    return texts.mapInArrow(run, PARTS)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))


def on_doc(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """``a`` joined with ``b`` on id (nulls alike) and text hash, with ``a``'s key columns."""
    b = b.withColumnsRenamed({"doc_id": "b_doc", "text_hash": "b_hash"})
    return a.join(b, a.doc_id.eqNullSafe(b.b_doc) & (a.text_hash == b.b_hash), how).drop("b_doc", "b_hash")


def contexts(docs: DataFrame, wanted: DataFrame, length: int = LENGTH) -> DataFrame:
    """The bytes left and right of the anchors of ``wanted`` parts, read from their documents."""
    names = ["doc_id", "text_hash", "group", "alone", "lo", "hi", "at", "before", "after"]
    kinds = [pa.int64()] * 3 + [pa.bool_()] + [pa.int32()] * 3 + [pa.binary()] * 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text, th, places in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3), strict=True):
                text = raw(text)
                for k in range(0, len(places.values), TOGETHER):
                    some = places.values.slice(k, TOGETHER).to_pylist()
                    rows = [(doc, th, p["group"], p["alone"], p["lo"], p["hi"], p["at"], text[p["lo"] : p["at"]], text[p["at"] : p["hi"] + length]) for p in some]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    places = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("group", "alone", "lo", "hi", "at")).alias("places"))
    found = on_doc(keyed(docs), places, "inner").select("doc_id", "text", "text_hash", "places")
    return found.mapInArrow(run, "doc_id long, text_hash long, group long, alone boolean, lo int, hi int, at int, before binary, after binary")


def again(group: list[tuple[bytes, bytes, int, int, bool]], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each (left part, right part, least and most bytes left of the anchor, alone):
    the ranges of left lengths whose window another member has too; none if not alone."""
    m = len(group)
    out: list[list[tuple[int, int]]] = [[] for _ in group]
    if m < 2:
        return out
    back = [left[::-1] for left, _, _, _, _ in group]
    rights = [right for _, right, _, _, _ in group]
    by_left, by_right = sorted_order(back), sorted_order(rights)
    lcp_left = np.array([common(back[i], back[j]) for i, j in zip(by_left, by_left[1:], strict=False)])
    lcp_right = np.array([common(rights[i], rights[j]) for i, j in zip(by_right, by_right[1:], strict=False)])
    low, high = np.array([g[2] for g in group]), np.array([g[3] for g in group])
    alone = np.array([g[4] for g in group])
    # which strings agree changes only where a common prefix ends or a run does
    edges = np.unique(np.concatenate([lcp_left + 1, length - lcp_right, low, high + 1]))
    edges = edges[(edges >= low.min()) & (edges <= high.max() + 1)]
    left, right = np.empty(m, np.int64), np.empty(m, np.int64)
    for a, b in zip(edges[:-1].tolist(), (edges[1:] - 1).tolist(), strict=True):
        left[by_left] = np.concatenate([[0], np.cumsum(lcp_left < a)])
        right[by_right] = np.concatenate([[0], np.cumsum(lcp_right < length - a)])
        inside = np.flatnonzero((low <= a) & (a <= high))
        _, which, count = np.unique(left[inside] * m + right[inside], return_inverse=True, return_counts=True)
        for i in inside[(count[which] > 1) & alone[inside]].tolist():
            if out[i] and out[i][-1][1] == a - 1:
                out[i][-1] = (out[i][-1][0], b)
            else:
                out[i].append((a, b))
    return out


def compared(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text_hash, start, end) of what is repeated in the lone parts of each group."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for k in range(0, len(b), 512):
                yield from b.slice(k, 512).to_pylist()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _, members in groupby(rows(batches), key=lambda r: r["group"]):
            members = list(members)
            group = [(r["before"], r["after"], r["at"] - r["hi"], r["at"] - r["lo"], r["alone"]) for r in members]
            for r, ranges in zip(members, again(group, length), strict=True):
                out += [(r["doc_id"], r["text_hash"], r["at"] - b, r["at"] - a + length) for a, b in ranges]
            if len(out) > 50_000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64(), pa.int64(), pa.int32(), pa.int32()], strict=True)], ["doc_id", "text_hash", "start", "end"])

    return found.repartition("group").sortWithinPartitions("group").mapInArrow(run, "doc_id long, text_hash long, start int, end int")


def counted(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """As :func:`compared`, by counting every window's hash over all tasks."""
    names = ["doc_id", "text_hash", "alone", "start", "window"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, len(b), 64):
                out: list[tuple] = []
                for r in b.slice(k, 64).to_pylist():
                    text = r["before"] + r["after"]
                    out += [(r["doc_id"], r["text_hash"], r["alone"], r["lo"] + i, xxhash.xxh3_128_digest(text[i : i + length])) for i in range(r["hi"] - r["lo"] + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()], strict=True)], names)

    windows = store(found.mapInArrow(run, "doc_id long, text_hash long, alone boolean, start int, window binary"), "windows")
    # a class that is not alone has its windows elsewhere as well
    twice = windows.groupBy("window").agg(F.sum(F.when(F.col("alone"), 1).otherwise(2)).alias("total")).where("total > 1")
    again = store(windows.where("alone").join(twice, "window", "left_semi").select("doc_id", "text_hash", "start", (F.col("start") + length).alias("end")), "again")
    drop(windows)
    return again


def repeated_spans(docs: DataFrame, length: int = LENGTH, large: int = LARGE, among: DataFrame | None = None) -> DataFrame:
    """(doc_id, text_hash, spans) of the documents that hold repeated strings of ``length`` bytes.

    ``among`` (doc_id, text_hash) names the documents that can hold one, if that is known.
    """
    parts = store(find_parts(docs, length, among), "parts")
    place = F.struct("text_hash", "at", "doc_id", "lo", "hi")
    differ = lambda low, high: (F.col(f"{low}.text_hash") != F.col(f"{high}.text_hash")) | (F.col(f"{low}.at") != F.col(f"{high}.at"))
    # copies of a text have the same places: they alone make no group
    groups = parts.where("group is not null").groupBy("group").agg(F.min(F.struct("text_hash", "at")).alias("low"), F.max(F.struct("text_hash", "at")).alias("high")).where(differ("low", "high"))
    groups = store(groups.select("group"), "groups")
    shared = store(parts.join(groups, "group"), "shared")
    within = store(parts.where("group is null").select("doc_id", "text_hash", F.col("lo").alias("start"), F.col("hi").alias("end")), "within")
    drop(parts, groups)
    classes = shared.groupBy("group", "ctx").agg(F.min(place).alias("one"), F.max(place).alias("other"))
    classes = store(classes.select("group", "ctx", "one", (~differ("one", "other")).alias("alone")), "classes")
    whole = shared.join(classes.where("not alone").select("group", "ctx"), ["group", "ctx"]).select("doc_id", "text_hash", F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))
    whole = store(whole.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "whole")
    drop(shared)
    open_groups = classes.groupBy("group").agg(F.count("*").alias("classes"), F.bool_or("alone").alias("some")).where("classes > 1 and some").select("group", "classes")
    wanted = store(classes.join(open_groups, "group").select("one.*", "group", "alone", "classes"), "wanted")
    drop(classes)
    found = store(contexts(docs, wanted.where(F.col("classes") <= large), length), "contexts")
    made = [store(compared(found, length), "compared")]
    drop(found)
    if not wanted.where(F.col("classes") > large).isEmpty():
        made.append(counted(contexts(docs, wanted.where(F.col("classes") > large), length), length))
    ids = keyed(docs).select("doc_id", "text_hash", F.octet_length("text").alias("end"))
    copied = ids.where(F.col("end") >= length).groupBy("text_hash", "end").agg(F.count("*").alias("n")).where("n > 1")
    copies = ids.join(copied.select("text_hash", "end"), ["text_hash", "end"]).select("doc_id", "text_hash", F.lit(0).alias("start"), "end")
    rows = reduce(DataFrame.union, made, within).union(copies).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    out = store(rows.union(whole).groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")
    drop(within, whole, wanted, *made)
    return out


def cut(text: bytes, spans: list[dict] | None, goes: Callable[[bytes], bool] = bool) -> tuple[bytes, int]:
    """What stays of the text, and how many maximal runs went; ``goes`` tells which do."""
    kept, done, gone = [], 0, 0
    for start, end in joined((x["start"], x["end"]) for x in spans or []):
        if goes(text[start:end]):
            kept.append(text[done:start])
            done, gone = end, gone + 1
    return b"".join([*kept, text[done:]]), gone


def is_passage(run: bytes) -> bool:
    """Whether a repeated run is a passage: over PASSAGE_WORDS words, or LENGTH bytes."""
    return len(run) >= LENGTH or len(run.split()) > PASSAGE_WORDS


def holding(spans: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_hash) of the documents with a run of ``length`` bytes or more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [any(e - s >= length for s, e in joined((x["start"], x["end"]) for x in found)) for found in b.column(2).to_pylist()]
            yield b.select(["doc_id", "text_hash"]).filter(pa.array(keep, pa.bool_()))

    return spans.select("doc_id", "text_hash", "spans").mapInArrow(run, "doc_id long, text_hash long")


def remove_repeats(docs: DataFrame, length: int = LENGTH, large: int = LARGE, passage: int | None = None) -> DataFrame:
    """Per document: bytes, bytes removed, maximal removed runs, digest of what stays.

    With ``passage``, also ``n_passages``: the repeated runs of strings of so many bytes
    that :func:`is_passage` holds for.  Only documents with such a run of ``length`` bytes
    can hold a repeated string of that length, so the others are not searched for it.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, spans, short in zip(b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                text = raw(text)
                kept, gone = cut(text, spans)
                rows.append((len(text), len(text) - len(kept), gone, hashlib.sha256(kept).hexdigest(), cut(text, short, is_passage)[1]))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 3 + [pa.string(), pa.int64()], strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages"])

    if passage is None:
        spans = repeated_spans(docs, length, large).withColumn("short", F.lit(None).cast("array<struct<start:int,end:int>>"))
    else:
        short = repeated_spans(docs, passage, large)
        spans = on_doc(short.withColumnRenamed("spans", "short"), repeated_spans(docs, length, large, holding(short, length)), "left")
    found = on_doc(keyed(docs), spans, "left").select("doc_id", "text", "spans", "short")
    out = found.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long")
    return out if passage else out.drop("n_passages")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), passage=PASSAGE_BYTES)
