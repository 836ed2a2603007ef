"""Operator 12: phrase collocations by multikey quicksort of suffix pointers.

A text's pieces are word sequences; a suffix is a place in a piece with the up to ``most``
words that stand from there on.  Tasks turn chunks of text into distinct suffixes with
weights, and route them by their two leading words to buckets of some ``BUCKET`` suffixes.
A bucket sorts pointers to its suffixes with three-way multikey quicksort, as deep as phrases
are long: the pointers that equal the pivot are a phrase's occurrences, so the size of that
partition is the phrase's count.  As all suffixes of a pair of leading words are in one
bucket, a partition lighter than ``least`` is abandoned at once.

Words that make up a ``HOT``-th of all words or more (so at most ``HOT`` of them) are
known beforehand.  A pair of two such words is routed by its third word too; its buckets give
parts of its count, which are summed.  Counts of single words come from the first pass.

All counts are exact and cover whole texts.  Null text counts as empty, null ``lang`` as
``und``; an empty table has no phrases.  Repeated rows count as often as they stand there;
equal scores rank by count, then by the phrase's UTF-8 bytes.  Texts are cut into chunks
between documents, so the longest document must fit a task's memory; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.llm.common import documents, drop, store

LEAST, MOST, TOP = 10, 3, 2000
#: A longer candidate with so many hundredths of a phrase's occurrences makes the phrase go.
INSIDE = 50
BUCKET, CHUNK, HOT = 1 << 19, 1 << 20, 500
#: A hot word's count is joined in so many copies.
SALTS = 16
#: Piece ends become line feeds, word ends spaces, A-Z lower case; a table over bytes.
_FOLD = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b in b" \t" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def pieces(text: pa.Scalar) -> list[list[bytes]]:
    if not text.is_valid:
        return []
    # split() would also cut at other control bytes, but they are line feeds by now
    return [w for p in text.as_buffer().to_pybytes().translate(_FOLD).split(b"\n") if (w := p.split())]


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n): all words with their counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter[bytes]] = defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, count in seen.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(count), pa.string()), pa.array(list(count), pa.binary()).cast(pa.string()), pa.array(list(count.values()), pa.int64())], ["lang", "word", "n"])
            seen.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for piece in pieces(text):
                    seen[lang].update(piece)
            if sum(map(len, seen.values())) > CHUNK // 2:
                yield from rows()
        yield from rows()

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def distinct_suffixes(ids: np.ndarray, most: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of two words or more of a run of word numbers from 1, 0 between pieces: a column each, 0 after the end; and how often each stands."""
    cols = np.zeros((most, len(ids)), np.int64)
    going = np.ones(len(ids), bool)
    for k in range(most):
        there = np.zeros(len(ids), np.int64)
        there[: max(len(ids) - k, 0)] = ids[k:]
        going &= there > 0
        cols[k] = np.where(going, there, 0)
    cols = cols[:, cols[1] > 0]
    bits = size.bit_length()
    if bits * most <= 63:
        key = np.zeros(cols.shape[1], np.int64)
        for c in cols:
            key = key << bits | c
        key.sort()
        first = np.flatnonzero(np.diff(key, prepend=-1))
        made = np.stack([key[first] >> bits * (most - 1 - k) & (1 << bits) - 1 for k in range(most)])
        return made, np.diff(first, append=len(key))
    made, weight = np.unique(cols, axis=1, return_counts=True)
    return made, weight


def mixed(hashes: list[np.ndarray]) -> np.ndarray:
    out = np.zeros_like(hashes[0])
    for h in hashes:
        out = (out ^ h) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def routed(docs: DataFrame, buckets: int, hot: dict[str, set[bytes]], most: int) -> DataFrame:
    """(bucket, lang, split, words, places): packed suffixes of a chunk; ``split`` if their pair of leading words goes to several buckets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, dict[bytes, int]] = defaultdict(dict)
        flat: dict[str, list[int]] = defaultdict(list)

        def packed(lang: str) -> Iterator[pa.RecordBatch]:
            words = [b"", *number[lang]]
            cols, weight = distinct_suffixes(np.array(flat[lang], np.int64), most, len(words))
            if not len(weight):
                return
            hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
            common = np.fromiter((w in hot.get(lang, ()) for w in words), bool, len(words))
            own = np.full(len(weight), xxhash.xxh3_64_intdigest(lang.encode()), np.uint64)
            route = mixed([own, hashed[cols[0]], hashed[cols[1]]])
            split = common[cols[0]] & common[cols[1]]
            if most > 2:
                route[split] = mixed([route[split], hashed[cols[2][split]]])
            slot = (route % np.uint64(buckets)).astype(np.int64) * 2 + split
            order = np.argsort(slot, kind="stable")
            cuts = np.flatnonzero(np.diff(slot[order], prepend=-1, append=-1))
            out: list[list] = [[], [], [], [], []]
            for a, z in zip(cuts, cuts[1:], strict=False):
                at = order[a:z]
                used, inverse = np.unique(cols[:, at], return_inverse=True)
                used = used if used[0] == 0 else np.concatenate([[0], used])
                shift = len(used) - (inverse.max() + 1)
                body = np.concatenate([inverse.reshape(-1) + shift, weight[at]]).astype("<u4")
                planes = np.ascontiguousarray(body.view(np.uint8).reshape(-1, 4).T).tobytes()
                row = [int(slot[at[0]] >> 1), lang, bool(slot[at[0]] & 1), zstandard.compress(b"\n".join(words[i] for i in used[1:].tolist()), 1), zstandard.compress(planes, 1)]
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["bucket", "lang", "split", "words", "places"])

        def rows() -> Iterator[pa.RecordBatch]:
            for lang in list(flat):
                yield from packed(lang)
            number.clear()
            flat.clear()

        n = 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids, known = flat[lang], number[lang]
                for piece in pieces(text):
                    ids += [known.setdefault(w, len(known) + 1) for w in piece]
                    ids.append(0)
                    n += len(piece)
                if n >= CHUNK:
                    yield from rows()
                    n = 0
        yield from rows()

    kinds = [pa.int32(), pa.string(), pa.bool_(), pa.binary(), pa.binary()]
    return docs.mapInArrow(run, "bucket int, lang string, split boolean, words binary, places binary")


def multikey(cols: np.ndarray, weight: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a pointer, length, weight) of every word sequence from the suffixes' starts that weighs ``least`` for its length.

    Three-way multikey quicksort of pointers into ``cols`` (a row per depth, 0 after the end): all
    partitions of a round are split at once, each at the median of three of its words at its depth.
    ``least`` does not fall with length; a partition that is too light for its depth is left unsorted.
    """
    pointer = np.arange(cols.shape[1])
    lo, size, depth = np.array([0]), np.array([len(pointer)]), np.array([0])
    need, found = np.array([*least, 0]), []
    while len(lo := lo[size > 0]):
        depth, size = depth[size > 0], size[size > 0]
        part = np.repeat(np.arange(len(lo)), size)
        first = np.cumsum(size) - size
        place = np.arange(len(part)) + np.repeat(lo - first, size)
        at = pointer[place]
        key = cols[depth[part], at]
        three = np.sort(np.stack([key[first], key[first + size // 2], key[first + size - 1]]), axis=0)
        pivot = three[1]
        side = 1 + (key > pivot[part]).astype(np.int64) - (key < pivot[part])
        slot = part * 3 + side
        count = np.bincount(slot, minlength=3 * len(lo))
        heavy = np.bincount(slot, weight[at], minlength=3 * len(lo)).astype(np.int64)
        start = np.repeat(lo, 3) + np.cumsum(count) - count - np.repeat(first, 3)
        moved = np.empty_like(at)
        for s in range(3):
            mine, n = at[side == s], count[s::3]
            moved[np.arange(len(mine)) + np.repeat(start[s::3] - lo + first - np.cumsum(n) + n, n)] = mine
        pointer[place] = moved
        below = np.repeat(depth, 3)
        equal = np.tile([False, True, False], len(lo))
        below[equal] += 1
        there = np.ones(len(equal), bool)
        there[equal] = pivot > 0
        full = there & equal & (heavy >= need[below - 1]) & (below > 1)
        found.append((pointer[start[full]], below[full], heavy[full]))
        keep = there & (below < len(least)) & (heavy >= need[np.minimum(below, len(least))])
        lo, size, depth = start[keep], count[keep], below[keep]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def phrase_counts(suffixes: DataFrame, least: int, most: int) -> DataFrame:
    """(lang, phrase, a): all phrases of 2 to ``most`` words that stand ``least`` times or more."""

    def run(table: pa.Table) -> pa.Table:
        number: dict[tuple[str, bytes], int] = {}
        cols, weights, splits = [], [], []
        for lang, split, words, places in zip(*(table.column(c).to_pylist() for c in ("lang", "split", "words", "places")), strict=True):
            ids = np.array([0, *(number.setdefault((lang, w), len(number) + 1) for w in zstandard.decompress(words).split(b"\n"))], np.int64)
            planes = np.frombuffer(zstandard.decompress(places), np.uint8).reshape(4, -1)
            body = np.ascontiguousarray(planes.T).view("<u4").ravel()
            n = len(body) // (most + 1)
            cols.append(ids[body[: n * most].reshape(most, n)])
            weights.append(body[n * most :].astype(np.int64))
            splits.append(np.full(n, split))
        names, col, weight, split = list(number), np.concatenate(cols, axis=1), np.concatenate(weights), np.concatenate(splits)
        langs, phrases, counts = [], [], []
        for mask, need in ((~split, [least] * most), (split, [1] * min(most, 2) + [least] * (most - 2))):
            mine = np.flatnonzero(mask)
            if len(mine):
                at, length, a = multikey(col[:, mine], weight[mine], need)
                for p, k, n in zip(mine[at].tolist(), length.tolist(), a.tolist(), strict=True):
                    phrase = [names[i - 1] for i in col[:k, p].tolist()]
                    langs.append(phrase[0][0])
                    phrases.append(b" ".join(w for _, w in phrase))
                    counts.append(n)
        return pa.table([pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["lang", "phrase", "a"])

    found = suffixes.groupBy("bucket").applyInArrow(run, "lang string, phrase string, a long")
    return found.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def part(words, first, n):
    return F.array_join(F.slice(words, first, n), " ")


def with_counts(cuts: DataFrame, counts: DataFrame, side: str, out: str, hot: list[str]) -> DataFrame:
    """``cuts`` with the count of the phrase in column ``side``; a hot word's count is there in ``SALTS`` copies."""
    common = lambda c: F.concat_ws(" ", "lang", c).isin(hot) if hot else F.lit(False)
    left = cuts.withColumn("_salt", F.when(common(side), F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))
    right = counts.select("lang", F.col("part").alias(side), F.col("f").alias(out), F.explode(F.when(common("part"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("_salt"))
    return left.join(right, ["lang", side, "_salt"]).drop("_salt")


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language, as the module says.

    score is floor(1,000,000 a a / (l r)) at the lowest-scoring cut of the phrase into l and r.
    """
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    counted = store(word_counts(own), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    total = totals.agg(F.sum("n")).first()[0] or 0
    hot: dict[str, set[bytes]] = defaultdict(set)
    for r in counted.where(F.col("n") * HOT >= total).collect() if total else []:
        hot[r.lang].add(r.word.encode())
    grams = store(phrase_counts(routed(own, max(1, -(-total // BUCKET)), hot, most), least, most), "phrases")
    words = F.split("phrase", " ")
    counts = grams.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")).unionByName(counted.where(F.col("n") >= least).select("lang", F.col("word").alias("part"), F.col("n").alias("f")))
    cuts = grams.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(words) - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(words, F.lit(1), F.col("k")).alias("left"), part(words, F.col("k") + 1, F.size(words) - F.col("k")).alias("right"))
    names = [f"{lang} {w.decode()}" for lang, ws in sorted(hot.items()) for w in sorted(ws)]
    for side, out in (("left", "l"), ("right", "r")):
        cuts = with_counts(cuts, counts, side, out, names)
    wide = {c: f"cast({c} as decimal(15, 0))" for c in "alr"}
    cuts = cuts.withColumn("score", F.expr(f"(1000000 * {wide['a']} * {wide['a']}) div ({wide['l']} * {wide['r']})"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("least")).select("lang", "phrase", "a", "least.*")
    spans = F.expr("flatten(transform(sequence(2, size(w) - 1), s -> transform(sequence(1, size(w) - s + 1), i -> array_join(slice(w, i, s), ' '))))")
    longer = grams.withColumn("w", words).where(F.size("w") > 2).select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), F.col("a").alias("over")).groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("over") < inside * F.col("a"), F.lit(True)))
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    out = store(ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "collocations")
    drop(counted, grams)
    return out


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


OP12_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, w[i] AS g FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split)
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM split WHERE len(w) > 1)
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) > 2)
), f AS (SELECT lang, g, count(*) AS a, len(string_split(g, ' ')) AS size FROM grams GROUP BY 1, 2),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY 1),
cand AS (SELECT lang, g, a, string_split(g, ' ') AS w, size FROM f WHERE size > 1 AND a >= {LEAST}),
cuts AS (SELECT *, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, size)) AS k FROM cand)),
scored AS (
  SELECT c.lang, c.g, c.a, c.k, l.a AS l, r.a AS r, CAST((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.g = c.x JOIN f r ON r.lang = c.lang AND r.g = c.y
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
over AS (
  SELECT lang, g, max(a) AS a FROM (
    SELECT lang, w[1] || ' ' || w[2] AS g, a FROM cand WHERE size = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM cand WHERE size = 3
  ) GROUP BY 1, 2
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.g) AS rank
  FROM best b LEFT JOIN over o ON o.lang = b.lang AND o.g = b.g WHERE o.a IS NULL OR 100 * o.a < {INSIDE} * b.a
)
SELECT r.lang, CAST(rank AS BIGINT) AS rank, g AS phrase, r.a, r.l, r.r, t.n, score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= {TOP}
"""
