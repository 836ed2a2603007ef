"""Operator 9: document fingerprints from closed syncmers, in DataFrame functions only.

A text's words are hashed; an s-mer is two words, a k-mer four.  A k-mer is chosen
if the least of its three s-mers lies at its first or last place.  The choice
depends on the k-mer alone, so equal passages give equal anchors wherever they
stand.  The fingerprint holds all chosen k-mers, each with its hash, its place and
how many of the same hash stand before it.  Two fingerprints are matched by place:
the n-th anchor of a hash with the n-th of the same hash.  Each distinct hash that is
matched votes for the difference of its two places, in steps of ``DRIFT`` words, and two
neighbouring steps have the most votes: these hashes stand in place, the others elsewhere.
The likeness is the share of the distinct hashes of the union that are matched in
place, so passages in another order count less than in the same one; it is exact for texts
of any length.  :func:`fingerprints` counts all matched hashes, wherever they stand (their
Jaccard similarity).

With fewer than four words the whole sequence is the one anchor; the query does the
same for four words whose one k-mer is not chosen (``always``).  Null or blank
text has an empty fingerprint; two empty ones are alike (1.0).  Null ids come
last in descending order; repeated ids are ordered by their text's hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.llm.common import documents

K, S = 4, 2
#: Places may drift by so many words, by what was put in or taken out before them.
DRIFT_BITS = 6
DRIFT = 1 << DRIFT_BITS


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also within lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def anchors(text: Column, always: bool = False) -> Column:
    """(position of the first word, hash) of every closed syncmer; ``always`` gives four words without one the whole sequence."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def pairs(h: Column) -> Column:  # its last one is not used
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1)))

    def chosen(p: Column) -> Column:
        # p[i], p[i+1], p[i+2] are the s-mers of the k-mer at i
        at = F.transform(F.slice(p, F.lit(1), F.greatest(F.size(p) - (K - 1), F.lit(0))), lambda x, i: F.when(F.least(x, F.get(p, i + 2)) <= F.get(p, i + 1), F.struct(i.alias("at"), F.xxhash64(x, F.get(p, i + 2)).alias("hash"))))
        return F.filter(at, lambda a: a.isNotNull())

    def of(h: Column) -> Column:
        none = F.array().cast("array<struct<at:int,hash:bigint>>")
        whole = F.array(F.struct(F.lit(0).alias("at"), F.xxhash64(h).alias("hash")))
        found = bound(pairs(h), chosen)
        found = bound(found, lambda a: F.when(F.size(a) == 0, whole).otherwise(a)) if always else found
        return F.when(F.size(h) == 0, none).when(F.size(h) < K, whole).otherwise(found)

    return bound(hashes, of)


def placed(anchors: Column) -> Column:
    """(hash, nth, at) of all anchors, ascending; ``nth`` counts the anchors of one hash from 0."""

    def of(x: Column) -> Column:
        new = F.filter(F.transform(x, lambda y, i: F.when((i == 0) | (y["hash"] != F.get(x, i - 1)["hash"]), i)), lambda i: i.isNotNull())

        def runs(starts: Column) -> Column:
            until = lambda j: F.coalesce(F.get(starts, j + 1), F.size(x)) - 1
            each = F.transform(starts, lambda start, j: F.transform(F.sequence(start, until(j)), lambda k: F.struct(F.get(x, k)["hash"].alias("hash"), (k - start).alias("nth"), F.get(x, k)["at"].alias("at"))))
            return F.flatten(each)

        return bound(new, runs)

    return bound(F.sort_array(F.transform(anchors, lambda y: F.struct(y["hash"].alias("hash"), y["at"].alias("at")))), of)


def fingerprint(text: Column, always: bool = False) -> Column:
    """All anchors as (hash, nth, at), ascending."""
    return placed(anchors(text, always))


def distinct(marks: Column) -> Column:
    return F.filter(marks, lambda x: x["nth"] == 0)


def written(marks: Column) -> Column:
    """The distinct hashes, ascending."""
    return F.array_join(F.transform(distinct(marks), lambda x: F.lower(F.lpad(F.hex(x["hash"]), 16, "0"))), "")


def written_places(marks: Column) -> Column:
    """Each distinct hash's places, joined by plus signs, in the order of ``written``."""
    return F.substring(F.array_join(F.transform(marks, lambda x: F.concat(F.when(x["nth"] == 0, ",").otherwise("+"), x["at"].cast("string"))), ""), 2, 2**31 - 1)


def matched(a: Column, b: Column) -> Column:
    """Positional matching of two fingerprints: (place in a, place in b, nth) of all anchors that both hold."""
    side = lambda marks, n: F.transform(marks, lambda x: F.struct(x["hash"].alias("hash"), x["nth"].alias("nth"), F.lit(n).alias("side"), x["at"].alias("at")))

    def pairs(u: Column) -> Column:
        def pair(x: Column, y: Column) -> Column:
            return F.when((x["hash"] == y["hash"]) & (x["nth"] == y["nth"]), F.struct(x["at"].alias("a"), y["at"].alias("b"), x["nth"].alias("nth")))

        return F.filter(F.transform(u, lambda x, i: pair(x, F.get(u, i + 1))), lambda p: p.isNotNull())

    return bound(F.sort_array(F.concat(side(a, 0), side(b, 1))), pairs)


def in_place(matched: Column) -> Column:
    """How many of the distinct ``matched`` hashes agree on a difference of places: the most in two neighbouring steps of DRIFT words."""

    def most(steps: Column) -> Column:
        new = F.filter(F.transform(steps, lambda x, i: F.when((i == 0) | (x != F.get(steps, i - 1)), i)), lambda i: i.isNotNull())

        def votes(starts: Column) -> Column:
            until = lambda j: F.coalesce(F.get(starts, j), F.size(steps))
            own = lambda at, j: until(j + 1) - at + F.when(F.get(steps, F.get(starts, j + 1)) == F.get(steps, at) + 1, until(j + 2) - until(j + 1)).otherwise(0)
            return F.coalesce(F.array_max(F.transform(starts, own)), F.lit(0))

        return bound(new, votes)

    return bound(F.sort_array(F.transform(matched, lambda p: F.shiftright(p["a"] - p["b"], DRIFT_BITS))), most)


def likeness(a: Column, b: Column, pairs: Column, placed: bool = False) -> Column:
    """Share of the union's distinct hashes that ``pairs``, the matching of a and b, holds (``placed``: in place); 1 if both are empty."""
    size = F.size(distinct(a)) + F.size(distinct(b))
    share = bound(distinct(pairs), lambda both: (in_place(both) if placed else F.size(both)) / (size - F.size(both)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(share).cast("double")


def matches(a: Column, b: Column) -> Column:
    """Positional matching of two texts' anchor lists: (place in a, place in b, nth), by place in a."""
    return F.sort_array(matched(placed(a), placed(b)))


def with_next(docs: DataFrame, parts: int, always: bool = False) -> DataFrame:
    """Each document with ``after``, the text of the next one in descending doc_id; the first one's after the last.

    Ids are dealt to ``parts`` buckets by their quantiles.  A bucket's top document
    is also sent to the bucket above, whose last document it follows; the topmost
    goes to the lowest.  The driver sees one row per bucket.
    """
    step = max(1, math.isqrt(parts))
    cuts = docs.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10000)).first()[0] or []
    coarse, fine = F.array(*map(F.lit, cuts[step - 1 :: step])).cast("array<bigint>"), F.array(*map(F.lit, cuts)).cast("array<bigint>")
    below = lambda bounds: F.size(F.filter(bounds, lambda b: b < F.col("doc_id")))
    dealt = docs.select("doc_id", "text", below(coarse).alias("c")).select("doc_id", "text", (F.col("c") * step + F.size(F.filter(F.slice(fine, F.col("c") * step + 1, step), lambda b: b < F.col("doc_id")))).alias("bucket"))
    tops = sorted(dealt.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect())
    heir = {r.bucket: tops[(i + 1) % len(tops)].bucket for i, r in enumerate(tops)}
    top = {r.bucket: r.top for r in tops}
    n = max(heir, default=0) + 1
    heirs = F.array(*(F.lit(heir.get(i, 0)) for i in range(n)))
    highest = F.array(*(F.lit(top.get(i)).cast("bigint") for i in range(n)))
    homes = F.when(F.col("doc_id").eqNullSafe(F.get(highest, F.col("bucket"))), F.array(F.col("bucket"), F.get(heirs, F.col("bucket")))).otherwise(F.array(F.col("bucket")))
    rows = dealt.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.posexplode(homes).alias("guest", "home"))
    order = Window.partitionBy("home").orderBy("guest", F.desc_nulls_last("doc_id"), "tie")
    marked = rows.withColumn("after", F.lead("text").over(order)).withColumn("marks", fingerprint(F.col("text"), always))
    return marked.withColumn("after_marks", F.lead("marks").over(order)).where("guest = 0")


def compared(docs: DataFrame, parts: int | None = None, always: bool = True) -> DataFrame:
    """Fingerprint and places of each text and of its edited text, the numbers of anchors
    matched by place with the edited and the next text, and the likenesses."""
    parts = parts or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = with_next(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), parts, always)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    d = d.select("doc_id", n.cast("long").alias("n_chars"), "marks", "after_marks", F.concat(F.left("text", n - cut), F.left("after", cut)).alias("edited"))
    d = d.select("doc_id", "n_chars", "marks", "after_marks", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("edited"), always).alias("edited_marks"))
    marks, edited, after = F.col("marks"), F.col("edited_marks"), F.col("after_marks")

    def near(other: Column) -> Column:
        return bound(matched(marks, other), lambda p: F.struct(F.size(p).cast("long").alias("n"), likeness(marks, other, p, placed=always).alias("share")))

    d = d.select("doc_id", "n_chars", "edited_sha256", written(marks).alias("fingerprint"), written(edited).alias("edited_fingerprint"), written_places(marks).alias("places"), written_places(edited).alias("edited_places"), near(edited).alias("edited"), near(after).alias("next"))
    return d.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", F.col("edited.share").alias("near_edited"), F.col("next.share").alias("near_next"), "places", "edited_places", F.col("edited.n").alias("matched_edited"), F.col("next.n").alias("matched_next"))


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprint of each text and of its edited text, and their likenesses, from closed syncmers alone."""
    return compared(docs, parts, always=False).drop("places", "edited_places", "matched_edited", "matched_next")


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(documents(spark, sf_dir))
