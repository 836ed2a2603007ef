"""Join shapes.  Sides are left to adaptive execution unless their size is bounded by kind."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.places import EARTH_M, half_sides, haversine_m, in_box


def inner(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    return a.join(b, on, "inner")


def left(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    return a.join(b, on, "left")


def override(base: DataFrame, exceptions: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Full outer join in which an exception's value wins over the base's."""
    b, e = base.select(*keys, F.col(value).alias("_base")), exceptions.select(*keys, F.col(value).alias("_except"))
    return b.join(e, keys, "full_outer").select(*keys, F.coalesce("_except", "_base").alias(value))


def expand_ranges(df: DataFrame, start: str, end: str, out: str, unit: str = "day") -> DataFrame:
    """A row for each step of the closed range; none for an empty or open one."""
    steps = F.sequence(F.col(start), F.col(end), F.expr(f"interval 1 {unit}"))
    return df.where(F.col(start) <= F.col(end)).withColumn(out, F.explode(steps))


#: Ranges are covered by blocks of 2**SHORTEST days, and of four times as many on each further level.
SHORTEST = 5


def _ends(start: Column, end: Column) -> tuple[Column, Column, Column]:
    """A closed range of days in shortest blocks, first and last, and the highest level that a block inside it can have."""
    p, q = F.shiftright(F.unix_date(start), SHORTEST), F.shiftright(F.unix_date(end), SHORTEST)
    return p, q, F.floor(F.log2((q - p + 1).cast("double")) / 2 + 1e-9).cast("int")


def cover(start: Column, end: Column) -> Column:
    """Blocks (level, block) that cover a closed range of days, none inside another: two or three for a month, under 60 up to 9999-12-31."""
    p, q, levels = _ends(start, end)
    steps = lambda lo, hi: F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    def own(k: Column) -> Column:
        first = lambda n: -F.call_function("shiftright", -p, 2 * n)
        last = lambda n: F.call_function("shiftright", q + 1, 2 * n) - 1
        lo, hi, up, top = first(k), last(k), first(k + 1), last(k + 1)
        # what whole blocks of the next level hold is left to it
        mine = F.when(up > top, steps(lo, hi)).otherwise(F.concat(steps(lo, up * 4 - 1), steps(top * 4 + 4, hi)))
        return F.transform(mine, lambda b: F.struct(k.alias("level"), b.alias("block")))

    return F.flatten(F.transform(F.sequence(F.lit(0), levels), own))


def match_ranges(points: DataFrame, ranges: DataFrame, point: str, start: str, end: str, on: tuple[str, ...] = ()) -> DataFrame:
    """Points joined to the closed date ranges that hold them, by equal blocks of days (and keys) rather than by comparison.

    A range is a row for each block of its :func:`cover`, however long it is; a point looks up
    its block on each level that the ranges can use (one number, found beforehand).
    """
    low, high = (F.col(c).cast("date") for c in (start, end))
    there = ranges.where(F.col(start) <= F.col(end))
    top = there.agg(F.max(_ends(low, high)[2])).first()[0] or 0
    blocks = there.withColumn("_at", F.explode(cover(low, high)))
    blocks = blocks.withColumns({"_level": F.col("_at.level"), "_block": F.col("_at.block")}).drop("_at")
    seen = points.where(F.col(point).isNotNull()).withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(top))))
    seen = seen.withColumn("_block", F.expr(f"shiftright(unix_date(cast(`{point}` as date)), {SHORTEST} + 2 * _level)"))
    return seen.join(blocks, ["_level", "_block", *on]).where(F.col(point).between(F.col(start), F.col(end))).drop("_level", "_block")


#: Pairs of a task, in joins whose keys have many rows on both sides.
PAIRS = 20_000_000


def dealt(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner", cond: Column | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Join on keys that few values share out among many rows: each task makes some ``PAIRS`` pairs, whatever a key's share.

    A key's left rows go to as many parts as its pairs need, and its right rows to each of these.  Memory holds
    the right rows of one key.  A task's left rows come by ``order``, so that like results are neighbours and
    take little room when they are written.  ``cond`` is a further condition; columns of both sides must have different names, but for the keys.
    """
    count = lambda df, name: df.groupBy(*on).agg(F.count("*").alias(name))
    parts = count(a, "_a").join(count(b, "_b"), on).select(*on, F.ceil(F.col("_a").cast("double") * F.col("_b") / PAIRS).cast("int").alias("_parts"))
    n = parts.agg(F.sum("_parts")).first()[0] or 1
    if n < 2:
        joined = a.join(b.withColumnsRenamed({k: f"_{k}" for k in on}), _equal(on, cond), how)
        return joined.drop(*(f"_{k}" for k in on))
    part = F.pmod(F.xxhash64(*a.columns), F.coalesce("_parts", F.lit(1))).cast("int")
    left = a.join(parts, on, "left").withColumn("_part", part).drop("_parts").repartition(n, *on, "_part").sortWithinPartitions(*on, "_part", *order)
    # replicated rows outgrow what the planner expects of an explode: never broadcast them
    right = b.join(parts, on).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    keys = [*on, "_part"]
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys}).repartition(n, *(f"_{k}" for k in keys)).hint("merge")
    return left.join(right, _equal(keys, cond), how).drop(*keys[len(on) :], *(f"_{k}" for k in keys))


def _equal(keys: list[str], cond: Column | None) -> Column:
    """Equality of the keys with the right side's, which begin with a low line, and ``cond``."""
    out = [F.col(k) == F.col(f"_{k}") for k in keys] + ([] if cond is None else [cond])
    return reduce(Column.__and__, out)


def within_box(a: DataFrame, b: DataFrame, on: list[str], a_at: tuple[str, str], b_at: tuple[str, str], radius_m: float = 300.0) -> DataFrame:
    """Left join on keys and a box around the right side's point; unmatched rows stay."""
    near = [a[k] == b[k] for k in on] + [in_box(a[a_at[0]], a[a_at[1]], b[b_at[0]], b[b_at[1]], radius_m)]
    cond = near[0]
    for c in near[1:]:
        cond = cond & c
    return a.join(b, cond, "left").drop(*(b[k] for k in on))


def dealt_box(a: DataFrame, b: DataFrame, on: list[str], a_at: tuple[str, str], b_at: tuple[str, str], radius_m: float = 300.0, how: str = "left", cond: Column | None = None) -> DataFrame:
    """:func:`within_box` by :func:`dealt`, for keys that few values share out; the edges of a box are found once a right row."""
    high, wide = half_sides(F.col(b_at[0]), radius_m)
    edges = {"_south": F.col(b_at[0]) - high, "_north": F.col(b_at[0]) + high, "_west": F.col(b_at[1]) - wide, "_east": F.col(b_at[1]) + wide}
    inside = F.col(a_at[0]).between(F.col("_south"), F.col("_north")) & F.col(a_at[1]).between(F.col("_west"), F.col("_east"))
    return dealt(a, b.withColumns(edges), on, how, inside if cond is None else inside & cond, a_at).drop(*edges)


#: One in so many right rows gives a bound of the least weight.
BOUND = 32


def nearest(a: DataFrame, b: DataFrame, on: list[str], a_at: tuple[str, str], b_at: tuple[str, str], a_key: str, pick: str, tie: str, radius_m: float = 300.0, steps: Column | None = None, shared: bool = False) -> DataFrame:
    """(a_key, pick, weighted): of the right rows in the box, the one of least distance times
    (steps + 1); ties by steps, then ``tie``.  Rows without a candidate keep NULLs.

    ``shared`` is for keys that few values share out: pairs are then dealt to tasks, and the least weight among
    some of the right rows bounds the least of all, so that few pairs have their distance computed and are ranked.
    """
    (lat, lon), (b_lat, b_lon) = a_at, b_at
    factor = (steps if steps is not None else F.lit(0)) + 1
    weighted = haversine_m(F.col(lat), F.col(lon), F.col(b_lat), F.col(b_lon)) * factor
    if shared:
        some = dealt_box(a, b.where(F.pmod(F.xxhash64(tie), F.lit(BOUND)) == 0), on, a_at, b_at, radius_m, "inner")
        bound = some.groupBy(F.col(a_key).alias("_of")).agg((F.min(weighted) * (1 + 1e-9) + 1e-6).alias("_bound"))
        bounded = a.join(bound, F.col(a_key) == F.col("_of"), "left").drop("_of")
        # no distance is less than the way north or south alone
        least = F.when(factor > 0, F.radians(F.abs(F.col(lat) - F.col(b_lat))) * EARTH_M * factor)
        may_be = F.coalesce(least <= F.col("_bound"), F.lit(True)) & F.coalesce(weighted <= F.col("_bound"), F.lit(True))
        pairs = dealt_box(bounded, b, on, a_at, b_at, radius_m, "left", may_be)
    else:
        pairs = within_box(a, b, on, a_at, b_at, radius_m)
    rank = F.when(F.col(tie).isNotNull(), F.struct(weighted.alias("w"), factor.alias("f"), F.col(tie).alias("t")))
    best = pairs.groupBy(a_key).agg(F.min_by(F.col(pick), rank).alias(pick), F.min(rank).alias("r"))
    return best.select(a_key, pick, F.col("r.w").alias("weighted"))


def join_any(a: DataFrame, b: DataFrame, on: list[str], left_col: str, right_cols: list[str], how: str = "left") -> DataFrame:
    """Equal keys, and ``left_col`` equal to any of ``right_cols``."""
    cond = a[left_col] == b[right_cols[0]]
    for c in right_cols[1:]:
        cond = cond | (a[left_col] == b[c])
    for k in on:
        cond = (a[k] == b[k]) & cond
    return a.join(b, cond, how).drop(*(b[k] for k in on))


def cross(a: DataFrame, b: DataFrame) -> DataFrame:
    """All pairs; for fixed small lists, such as categories and months, only."""
    return a.crossJoin(b)


def flag_member(a: DataFrame, b: DataFrame, a_key: str, b_key: str, out: str) -> DataFrame:
    known = b.select(F.col(b_key).alias("_k")).where("_k is not null").distinct()
    return a.join(known, a[a_key] == F.col("_k"), "left").withColumn(out, F.col("_k").isNotNull()).drop("_k")


def restrict(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b.select(*keys), keys, "left_semi")


def missing_from(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b.select(*keys), keys, "left_anti")


def align_nth(a: DataFrame, b: DataFrame, keys: list[str], a_order: Sequence[Column | str], b_order: Sequence[Column | str], how: str = "left") -> DataFrame:
    """The n-th row of a key on the left with its n-th row on the right."""
    n = lambda df, order: df.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return n(a, a_order).join(n(b, b_order), [*keys, "nth"], how)


def as_of_version(points: DataFrame, versions: DataFrame, keys: list[str], point: str, start: str, end: str, order: list[Column], ready: Column | None = None, on: tuple[str, ...] = ()) -> DataFrame:
    """For each point, the first by ``order`` of the versions that hold it and were ready in time."""
    found = match_ranges(points, versions, point, start, end, on)
    found = found if ready is None else found.where(ready)
    return found.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def with_group_stats(df: DataFrame, keys: list[str], **stats: Column) -> DataFrame:
    """Group figures on every row, in one shuffle."""
    w = Window.partitionBy(*keys)
    return df.withColumns({name: agg.over(w) for name, agg in stats.items()})


def map_code(df: DataFrame, mapping: DataFrame, key: str, map_key: str, kind: str) -> DataFrame:
    """Left join of a mapping table on a key cast to the mapping's type."""
    return df.join(mapping, df[key].try_cast(kind) == mapping[map_key], "left")


def star(fact: DataFrame, dims: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    for dim, on in dims:
        fact = fact.join(dim, on, "left")
    return fact
