"""Operator 3: exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension (set where the component is above 0).
Codes are cut into segments of equal width, give or take a bit; two codes at distance D agree on some segment up to
floor(D / segments) bits.  Round r therefore probes every segment's values at
Hamming distance exactly r from the query's, made by
one bit after the other; after it all codes closer than segments * (r + 1) are
known.  A query leaves once its k-th verified distance is that small, so results
are exact.  The k-th distance comes from a query's counts per distance.  Where a round's probes would
cost more than all codes (``PROBE``), the queries that are left are compared with all codes
instead, ``TOGETHER`` of them at a time, dealt to tasks of ``PAIRS`` comparisons: only codes as near as
a query's k-th so far come out.

Equal codes are one row with their k + 1 smallest ids, so copies of one vector
cannot swell a bucket.  Neighbours are ordered by distance, then id; a vector is
not its own neighbour.  Rows with a null id or vector take no part; equal rows
count once; missing components count as 0.  Vectors of any length are read whole.
An empty table, or one without other vectors, gives no rows.  Further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.llm.common import drop, store


def packed(bits: Column, start: int, size: int) -> Column:
    """``size`` bits from ``start`` as one number."""
    return F.aggregate(F.slice(bits, start + 1, size), F.lit(0).cast("bigint"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b))


#: Codes of so many words are compared by a plain sum, which is compiled; longer ones by array functions.
FLAT = 64


def distance(a: Column, b: Column, dims: int) -> Column:
    words = -(-dims // 64)
    if words > FLAT:
        return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, n: acc + n)
    return reduce(Column.__add__, (F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(words)))


def codes(vectors: DataFrame, dims: int) -> DataFrame:
    """(vec_id, bits, code): code holds the bits as 64-bit words."""
    bits = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.when(F.get("embedding", i) > 0, F.lit(1)).otherwise(0).cast("bigint"))
    rows = vectors.where("vec_id is not null and embedding is not null").select("vec_id", bits.alias("bits"))
    return rows.select("vec_id", "bits", F.array(*(packed(F.col("bits"), i, 64) for i in range(0, dims, 64))).alias("code")).dropDuplicates(["vec_id", "code"])


def ring(segments: DataFrame, radius: int, width: Column) -> DataFrame:
    """(query, segment, value) for every value that differs in ``radius`` of the segment's ``width`` bits; each further bit stands above the last."""
    out = segments.withColumn("bit", F.lit(-1))
    above = F.filter(F.sequence(F.lit(0), width - 1), lambda b: b > F.col("bit"))
    for _ in range(radius):
        out = out.withColumn("bit", F.explode(above)).withColumn("value", F.col("value").bitwiseXOR(F.expr("shiftleft(1L, bit)")))
    return out.drop("bit")


#: Queries that are compared with all codes at a time; they are broadcast, some 100 bytes each.
TOGETHER = 4096
#: Comparisons of a task, and how many of them cost as much as a code that a probe finds (which is shuffled, made distinct and stored).
PAIRS, PROBE = 50_000_000, 300


def cuts(n: int, dims: int) -> list[tuple[int, int]]:
    """(start, width) of the segments for ``n`` codes: some log2(n) bits each, none much narrower than the others."""
    size = min(max(round(max(n, 2).bit_length() - 0.5), 8), 30, dims)
    parts = -(-dims // size)
    edges = [dims * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def probed(segments: list[tuple[int, int]], radius: int, n: int) -> float:
    """Values that a round probes for a query, or the codes that evenly spread bits hold there if these are more."""
    return sum(math.comb(w, radius) * max(1, n / 2**w) for _, w in segments)


def scanned(waiting: DataFrame, found: DataFrame, known: DataFrame, n: int, need: int, dims: int) -> list[DataFrame]:
    """(query, code, distance) as stored tables: for the queries that wait, all codes no farther than their need-th so far, from all ``n`` codes."""
    so_far = found.join(known.select("code", F.size("ids").alias("n")), "code").groupBy("query").agg(F.sum("n").alias("n"), F.max("distance").alias("far"))
    left = store(waiting.select("query").distinct().join(so_far, "query", "left").select("query", F.when(F.col("n") >= need, F.col("far")).otherwise(dims).alias("far")), "far")
    waits = left.count()
    batches = -(-waits // TOGETHER)
    # few bytes, much work: dealt by the comparisons
    codes_only, out = known.select("code").repartition(n * min(waits, TOGETHER) // PAIRS + 1), []
    for b in range(batches):
        # a share by hash is TOGETHER queries give or take a few hundredths
        some = left.where(F.pmod(F.xxhash64("query"), F.lit(batches)) == b)
        apart = distance(F.col("query"), F.col("code"), dims)
        pairs = codes_only.join(F.broadcast(some), apart <= F.col("far"))
        out.append(store(pairs.select("query", "code", apart.alias("distance")), "scanned"))
    drop(left)
    return out


def search(vectors: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, distance) for the vectors that ``queries`` selects, against all."""
    dims = max(vectors.select(F.max(F.size("embedding"))).first()[0] or 1, 1)
    rows = store(codes(vectors, dims), "codes")
    by_id = Window.partitionBy("code").orderBy("vec_id")
    least = rows.select("code", "vec_id", F.row_number().over(by_id).alias("n")).where(F.col("n") <= k + 1)
    known = store(least.groupBy("code").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "known")
    n, total = known.count(), rows.count()
    parts = cuts(n, dims)
    segments = lambda df: df.select("code", F.posexplode(F.array(*(packed(F.col("bits"), s, w) for s, w in parts))).alias("segment", "value"))
    table = store(segments(rows.dropDuplicates(["code"])), "segments")
    asked = rows.where(queries)
    waiting = store(segments(asked.dropDuplicates(["code"])).select(F.col("code").alias("query"), "segment", "value"), "asked")
    found, need = None, min(k + 1, total)
    width = F.get(F.array(*(F.lit(w) for _, w in parts)), F.col("segment"))
    for radius in range(max(w for _, w in parts) + 1):
        made: list[DataFrame] = []
        far = found is not None and probed(parts, radius, n) * PROBE > n
        if far:
            made = scanned(waiting, found, known, n, need, dims)
            new = reduce(DataFrame.union, made)
        else:
            probes = ring(waiting, radius, width)
            # a query's probes outgrow what the planner expects of an explode: never broadcast them
            new = probes.join(table.hint("merge"), ["segment", "value"]).select("query", "code").distinct().select("query", "code", distance(F.col("query"), F.col("code"), dims).alias("distance"))
        both = store((new if found is None else found.union(new).distinct()).join(known.select("code", F.size("ids").alias("n")), "code"), "both")
        # a query's codes up to the distance at which need ids are reached
        counts = both.groupBy("query", "distance").agg(F.sum("n").alias("n"))
        before = Window.partitionBy("query").orderBy("distance").rowsBetween(Window.unboundedPreceding, -1)
        ahead = counts.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
        kth = ahead.where(F.col("ahead") < need).groupBy("query").agg(F.max("distance").alias("kth"))
        old = [t for t in (found, both, *made) if t is not None]
        near = both.join(kth, "query").where(F.col("distance") <= F.col("kth"))
        found = store(near.select("query", "code", "distance"), "found")
        if far:
            drop(*old)
            break
        full = near.groupBy("query").agg(F.sum("n").alias("n"), F.max("distance").alias("kth")).where((F.col("n") >= need) & (F.col("kth") < len(parts) * (radius + 1)))
        waiting = store(waiting.join(full.select("query"), "query", "left_anti"), "waiting")
        drop(*old)
        if waiting.isEmpty():
            break
    near = found.join(known, "code").select("query", "distance", F.explode("ids").alias("vec_id"))
    first = Window.partitionBy("query").orderBy("distance", "vec_id")
    near = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    out = asked.select(F.col("vec_id").alias("query_id"), F.col("code").alias("query")).join(near, "query").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    return out.select("query_id", rank.alias("rank"), "vec_id", F.col("distance").cast("int").alias("distance")).where(F.col("rank") <= k)


def op3_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


OP3_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: (x > 0)::INT) AS bits FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(range(1, len(a.bits) + 1), lambda i: abs(a.bits[i] - b.bits[i])))::INT AS distance
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank, vec_id, distance FROM d)
SELECT * FROM r WHERE rank <= 10
"""
