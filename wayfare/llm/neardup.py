"""Operator 5: near-duplicates by MinHash bands, verified with odd sketches.

A document's set holds its distinct five-word shingles.  Documents with equal sets
form a class, and only classes are compared.  Each class has ``SAMPLES`` MinHash
values: groups of ``ROWS`` of them are band keys that propose candidates, and all
of them are folded into a parity bitmap (odd sketch) whose XOR population count
estimates the similarity of a proposed pair.  The estimate only drops pairs that
lie far below the threshold (by some seven standard deviations); what remains is
confirmed on the full sets.

A band bucket never emits all its pairs.  In each round up to ``PIVOTS`` members of a
bucket, of different components, are compared with all its members outside their own
component, and leave it; links merge components, and buckets whose members are all in one
component are done.  A bucket of few members is so compared whole in one round, and of a large
group of near copies almost all are joined.  What is still apart after ``ROUNDS`` rounds is
gathered by shared buckets into clusters.  A cluster's largest component, which need not be
compared with itself, and the rest are each cut into blocks of some ``BLOCK`` shingles, and tasks
compare a block of the rest with one other block: sketches first, full sets where components
differ, and only links that join two components come out.  So no link that matters is lost, and no
table grows with the square of a group; a block is copied once for each block of the rest.

Null or blank text has an empty set and links with nothing.  With fewer than five
words the whole sequence is the one shingle.  A null doc_id stays null; repeated
rows share a class.  Other columns are ignored.  An empty table gives an empty one; texts
are read whole, however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import LOWER_AZ, documents, drop, store
from wayfare.llm.graph import components

#: ``PERCENT`` is op5's threshold; other callers give their own.
WIDTH, PERCENT = 5, 85
ROWS, BANDS = 4, 24
SAMPLES, SKETCH_WORDS = ROWS * BANDS, 8
ROUNDS, PIVOTS = 2, 2
#: Shingles in a block of a cluster (8 bytes each).
BLOCK = 4_000_000
_P = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_RNG = np.random.default_rng(20240501)
_A = (_RNG.integers(1, 1 << 32, SAMPLES, np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RNG.integers(0, 1 << 32, SAMPLES, np.uint64).astype(np.uint32)
_SALT = _RNG.integers(1, 1 << 63, SAMPLES, np.uint64)


class Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, words: Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    found = (text or "").encode("utf-8", "replace").translate(LOWER_AZ).split()
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    if len(w) < WIDTH:
        out = np.array([len(w)], np.uint64)
        for x in w:
            out = mix(out * _P + x)
        return out
    n = len(w) - WIDTH + 1
    out = w[:n].copy()
    for j in range(1, WIDTH):
        out *= _P
        out += w[j : j + n]
    return np.unique(mix(out))


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SAMPLES minima per set; no set is empty."""
    x = np.concatenate(sets)
    x = (x ^ (x >> np.uint64(32))).astype(np.uint32)
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    return np.stack([np.minimum.reduceat(x * a + b, at) for a, b in zip(_A, _B, strict=True)], axis=1)


def band_keys(mins: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(mins), BANDS), np.uint64)
    for b in range(BANDS):
        k = np.full(len(mins), b + 1, np.uint64)
        for r in range(ROWS):
            k = mix(k * _P + mins[:, b * ROWS + r])
        keys[:, b] = k
    return keys.view(np.int64)


def odd_sketches(mins: np.ndarray) -> np.ndarray:
    """Parity bitmaps: each sample flips the bit that it and its minimum hash to."""
    n = len(mins)
    bit = mix((mins.astype(np.uint64) + np.uint64(1)) * _SALT) % np.uint64(64 * SKETCH_WORDS)
    parity = np.bincount((np.arange(n)[:, None] * 64 * SKETCH_WORDS + bit.astype(np.int64)).ravel(), minlength=n * 64 * SKETCH_WORDS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(n, 64 * SKETCH_WORDS), axis=1).view(np.int64)


def least_estimate(percent: int) -> float:
    """Pairs estimated below this, some seven deviations under the threshold, are dropped unverified."""
    share = percent / 100
    return round(share - 7 * float(np.sqrt(share * (1 - share) / SAMPLES)), 1)


def most_bits(percent: int) -> int:
    """The XOR count at which the estimated similarity falls to the least that ``percent`` allows."""
    size, estimate = 64 * SKETCH_WORDS, least_estimate(percent)
    return int(np.ceil(size / 2 * (1 - np.exp(-4 * SAMPLES * (1 - estimate) / size))))


def signatures(docs: DataFrame) -> DataFrame:
    """Per document: set size, class (digest of the set), band keys and odd sketch; null class if empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for whole in batches:
            for at in range(0, len(whole), 512):
                b = whole.slice(at, 512)
                sets = [shingle_set(t.as_py(), words) for t in b.column(1)]
                full = [s for s in sets if len(s)]
                mins = minhashes(full) if full else np.zeros((0, SAMPLES), np.uint32)
                row = iter(zip(band_keys(mins), odd_sketches(mins), strict=True))
                digests, bands, sketches = [], [], []
                for s in sets:
                    band, sketch = next(row) if len(s) else (None, None)
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    bands.append(band)
                    sketches.append(sketch)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))], ["doc_id", "text_hash", "n_shingles", "cls", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h")).mapInArrow(run, "doc_id long, text_hash long, n_shingles long, cls binary, bands array<long>, sketch array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, n, items) of the classes in ``wanted`` (doc_id, text_hash, cls), from one document of each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            sets = [shingle_set(t.as_py(), words) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "items"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    found = texts.join(wanted, texts.doc_id.eqNullSafe(wanted.doc_id) & (texts.text_hash == wanted.text_hash)).select("cls", "text")
    return found.mapInArrow(run, "cls binary, items binary").dropDuplicates(["cls"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those with 100 * intersection >= percent * union of their full sets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("cls").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("items").alias("items_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "items_a", "items_b").mapInArrow(run, "a binary, b binary")


def proposed(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose set sizes and odd sketches allow the threshold."""
    side = lambda x: classes.select(F.col("cls").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    apart = sum((F.bit_count(F.col("s_a")[i].bitwiseXOR(F.col("s_b")[i])) for i in range(1, SKETCH_WORDS)), F.bit_count(F.col("s_a")[0].bitwiseXOR(F.col("s_b")[0])))
    near = (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (apart <= most_bits(percent))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(near).select("a", "b")


def joining_links(group: list[dict], cross: bool, percent: int) -> Iterator[tuple[bytes, bytes]]:
    """Links between members of different components; each found one merges the two.

    Members: cls, root, block, sketch, items.  With ``cross`` only pairs of two blocks count.
    """
    if len({r["root"] for r in group}) < 2:
        return
    sets = [np.frombuffer(r["items"], np.uint64) for r in group]
    size = np.array([len(x) for x in sets])
    sketch = np.array([r["sketch"] for r in group], np.int64).view(np.uint64)
    block = np.array([r["block"] for r in group])
    names = {r: k for k, r in enumerate(dict.fromkeys(r["root"] for r in group))}
    root = np.array([names[r["root"]] for r in group])
    place = np.arange(len(group))
    for i in range(len(group)):
        near = (place > i) & (root != root[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
        js = np.flatnonzero(near & (block != block[i]) if cross else near)
        if not len(js):
            continue
        apart = np.bitwise_count(sketch[js] ^ sketch[i]).sum(1)
        keep = apart <= most_bits(percent)
        for j in js[keep][np.argsort(apart[keep], kind="stable")].tolist():
            if root[j] != root[i]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (size[i] + size[j] - both):
                    root[root == root[j]] = root[i]
                    yield group[i]["cls"], group[j]["cls"]


def links_within(members: DataFrame, percent: int) -> DataFrame:
    """Links that join components, for members (cluster, cls, root, n_shingles, sketch, items)."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for at in range(0, len(b), 64):
                yield from b.slice(at, 64).to_pylist()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), group in groupby(rows(batches), key=lambda r: (r["cluster"], r["i"], r["j"])):
            if found := list(joining_links(list(group), i != j, percent)):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found, strict=True)], ["a", "b"])

    size = members.groupBy("cluster", "root").agg(F.sum("n_shingles").alias("n"))
    blocks = size.groupBy("cluster").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"))
    cut = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    blocks = blocks.select("cluster", F.col("most.root").alias("large"), cut(F.col("most.n")).alias("large_blocks"), cut(F.col("n") - F.col("most.n")).alias("blocks"))
    dealt = members.join(blocks, "cluster").withColumn("is_large", F.col("root") == F.col("large"))
    # blocks of the rest are numbered from 0, those of the largest component from there on
    own = F.when(F.col("is_large"), F.col("blocks") + F.pmod(F.xxhash64("cls"), "large_blocks")).otherwise(F.pmod(F.xxhash64("cls"), "blocks")).cast("int")
    last = F.when(F.col("is_large"), F.col("blocks")).otherwise(F.col("blocks") + F.col("large_blocks")) - 1
    dealt = dealt.withColumn("block", own).select("cluster", "cls", "root", "sketch", "items", "block", F.explode(F.sequence(F.lit(0), last)).alias("other"))
    pairs = dealt.select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cls", "root", "block", "sketch", "items")
    return pairs.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(run, "a binary, b binary")


def open_buckets(labels: DataFrame) -> DataFrame:
    """(key, lo, hi): of the buckets with several components, the members of least and largest component."""
    return labels.groupBy("key").agg(F.min(F.struct("root", "cls")).alias("lo"), F.max(F.struct("root", "cls")).alias("hi")).where("lo.root <> hi.root")


def pivots_of(labels: DataFrame, step: int) -> DataFrame:
    """(key, pivots): of the buckets with several components, members of up to PIVOTS of them: the least of each share of the components."""
    share = F.pmod(F.xxhash64("root", F.lit(step)), F.lit(PIVOTS))
    least = [F.min(F.when(share == k, F.struct("root", "cls"))).alias(f"p{k}") for k in range(PIVOTS)]
    found = labels.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), *least).where("lo <> hi")
    return found.select("key", F.array_compact(F.array(*(f"p{k}" for k in range(PIVOTS)))).alias("pivots"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document: set size, the smallest doc_id it reaches by links of ``percent`` or more, and whether it is that one;
    ``text_hash`` tells rows of equal id apart."""
    found = store(signatures(docs), "signatures")
    full = found.where("cls is not null")
    classes = store(full.groupBy("cls").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_hash")).alias("one"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")
    slim = store(found.select("doc_id", "text_hash", "n_shingles", "cls"), "documents")
    drop(found)
    held = classes.select("cls", F.explode("bands").alias("key"))
    shared = held.groupBy("key").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high")
    rows = store(held.join(shared.select("key"), "key"), "buckets")
    wanted = rows.select("cls").distinct().join(classes, "cls").select("one.doc_id", "one.text_hash", "cls")
    sets = store(shingle_sets(docs, wanted), "sets")
    labels, links, done = rows.select("cls", "key", F.col("cls").alias("root")), None, []
    for step in range(ROUNDS):
        met = labels.join(pivots_of(labels, step), "key")
        pairs = met.select("cls", "root", F.explode("pivots").alias("pivot")).where("root <> pivot.root").select(F.least("pivot.cls", "cls").alias("a"), F.greatest("pivot.cls", "cls").alias("b")).distinct()
        new = store(confirm(proposed(pairs, classes, percent), sets, percent), "confirmed")
        links = new if links is None else links.union(new)
        roots = components(links)
        # a pivot has met all members of its bucket
        left = met.where(~F.exists("pivots", lambda p: p["cls"] == F.col("cls"))).select("cls", "key")
        labels = store(left.join(roots, left.cls == roots.node, "left").select("cls", "key", F.coalesce("root", "cls").alias("root")), "labels")
        done += [new, roots, labels]
    apart = labels.join(open_buckets(labels).select("key", F.col("lo.cls").alias("pivot")), "key")
    apart = store(apart.select("cls", "root", "pivot").distinct(), "apart")
    done.append(apart)
    if not apart.isEmpty():
        clusters = components(apart.select(F.col("pivot").alias("a"), F.col("cls").alias("b")))
        members = apart.select("cls", "root").distinct().join(clusters.withColumnsRenamed({"node": "cls", "root": "cluster"}), "cls").join(classes.select("cls", "n_shingles", "sketch"), "cls").join(sets, "cls")
        new = store(links_within(members, percent), "within")
        roots = components(links.union(new))
        done += [clusters, new, roots]
    top = classes.join(roots, classes.cls == roots.node).groupBy("root").agg(F.min("least").alias("component"))
    member = roots.join(top, "root").select(F.col("node").alias("cls"), "component")
    out = slim.join(classes.select("cls", "least"), "cls", "left").join(member, "cls", "left")
    out = store(out.select("doc_id", "text_hash", "n_shingles", F.coalesce("component", "least", "doc_id").alias("component_id")), "neardup")
    drop(classes, rows, slim, sets, *done)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents less all but one of each group of near-duplicates, all columns.

    Rows of equal id and text are one document, whatever else they hold: one of them stays.
    """
    found = near_duplicates(docs, percent).where("kept")
    group = F.coalesce("component_id", "text_hash")
    stays = found.groupBy("doc_id", group.alias("group")).agg(F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash").distinct()
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"]).alias("text_hash"))
    rows = rows.join(stays, rows.doc_id.eqNullSafe(stays.doc_id) & (rows.text_hash == stays.text_hash), "left_semi")
    return rows.dropDuplicates(["doc_id", "text_hash"]).select("row.*")


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("text_hash")


OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i+4], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach AS (SELECT doc_id AS node, doc_id AS low FROM documents UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.node WHERE r.low < l.b),
least AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN least l ON l.node = d.doc_id
"""
