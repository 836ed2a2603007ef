"""Data-quality checks: each returns the failing rows; no rows is a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.keys import safe_ratio
from wayfare.operators.aggregates import join_text, null_rate


class Check:
    """A named check: its failing rows, or the condition under which a row of ``table`` fails."""

    def __init__(self, name: str, failing: DataFrame | None = None, severity: str = "warn", table: DataFrame | None = None, fails: Column | None = None):
        if (failing is None) == (fails is None) or (table is None) != (fails is None):
            raise ValueError("a check has failing rows, or a table and a condition")
        self.name, self.severity, self.table, self.fails = name, severity, table, fails
        self.failing = table.where(fails) if failing is None else failing


def _where(df: DataFrame, where: str | None) -> DataFrame:
    return df.where(where) if where else df


def summarise(checks: list[Check]) -> DataFrame:
    """(check, severity, failures), in one job over all checks; the row-wise checks of a table are one scan of it.

    Tables are the same if they are the same DataFrame object.
    """
    one = lambda name, severity, n: F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"), n.alias("failures"))
    by_table: dict[int, list[Check]] = {}
    for c in checks:
        if c.fails is not None:
            by_table.setdefault(id(c.table), []).append(c)
    rows = [c.failing.agg(F.count("*").alias("n")).select(one(c.name, c.severity, F.col("n")).alias("r")) for c in checks if c.fails is None]
    for own in by_table.values():
        counts = own[0].table.agg(*(F.count_if(c.fails).alias(f"n{i}") for i, c in enumerate(own)))
        rows.append(counts.select(F.explode(F.array(*(one(c.name, c.severity, F.col(f"n{i}")) for i, c in enumerate(own)))).alias("r")))
    return reduce(DataFrame.unionAll, rows).select("r.*")


def _and(where: str | None, bad: Column) -> Column:
    return F.expr(where) & bad if where else bad


def is_null(col: str, where: str | None = None) -> Column:
    return _and(where, F.col(col).isNull())


def not_accepted(col: str, values: list, where: str | None = None) -> Column:
    return _and(where, ~F.col(col).isin(values))


def out_of_range(col: str, low: object = None, high: object = None, where: str | None = None) -> Column:
    bad = F.lit(False)
    bad = bad | (F.col(col) < low) if low is not None else bad
    bad = bad | (F.col(col) > high) if high is not None else bad
    return _and(where, bad)


def is_false(expr: str, where: str | None = None) -> Column:
    return _and(where, ~F.expr(expr))


def not_null(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    return df.where(is_null(col, where))


def unique(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    return unique_combination(_where(df, where).where(F.col(col).isNotNull()), [col])


def unique_combination(df: DataFrame, cols: list[str], where: str | None = None) -> DataFrame:
    return _where(df, where).groupBy(*cols).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def accepted_values(df: DataFrame, col: str, values: list, where: str | None = None) -> DataFrame:
    return df.where(not_accepted(col, values, where))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str, where: str | None = None) -> DataFrame:
    known = parent.select(F.col(parent_col).alias(col))
    return _where(child, where).where(F.col(col).isNotNull()).join(known, col, "left_anti")


def accepted_range(df: DataFrame, col: str, low: object = None, high: object = None, where: str | None = None) -> DataFrame:
    return df.where(out_of_range(col, low, high, where))


def expression_is_true(df: DataFrame, expr: str, where: str | None = None) -> DataFrame:
    return df.where(is_false(expr, where))


def equal_rowcount(a: DataFrame, b: DataFrame) -> DataFrame:
    one = lambda df, n: df.agg(F.count("*").alias(n))
    return one(a, "n_a").crossJoin(one(b, "n_b")).where("n_a <> n_b")


def not_null_proportion(df: DataFrame, col: str, at_least: float, where: str | None = None) -> DataFrame:
    return _where(df, where).agg(safe_ratio(F.count(col), F.count("*"), 6).alias("proportion")).where(F.col("proportion") < at_least)


def mutually_exclusive_ranges(df: DataFrame, low: str, high: str, keys: list[str], gaps: bool = True, tie: tuple[str, ...] = ()) -> DataFrame:
    """Ranges that reach over the next one's start; without ``gaps``, also those that end before it.

    ``tie`` orders equal ranges; without it, which of them is named is open.
    """
    after = F.lead(low).over(Window.partitionBy(*keys).orderBy(low, high, *tie))
    return df.withColumn("next_start", after).where(F.col(high) > F.col("next_start") if gaps else F.col(high) != F.col("next_start"))


def null_rate_above(df: DataFrame, keys: list[str], col: str, percent: float = 5.0, where: str | None = None) -> DataFrame:
    return null_rate(_where(df, where), keys, col, percent)


def null_reasons(df: DataFrame, keys: list[str], col: str, reason: Column, percent: float = 5.0) -> DataFrame:
    """For groups whose null rate is too high, how many nulls each reason explains."""
    bad = null_rate(df, keys, col, percent).select(*keys)
    return df.join(bad, keys, "left_semi").where(F.col(col).isNull()).groupBy(*keys, reason.alias("reason")).agg(F.count("*").alias("n_null"))


def stage_loss(before: DataFrame, after: DataFrame, key: str, percent: float = 5.0) -> DataFrame:
    """Days on which more than ``percent`` of the rows were lost between two stages."""
    n = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    both = n(before, "n_before").join(n(after, "n_after"), key, "left").withColumn("n_after", F.coalesce("n_after", F.lit(0)))
    return both.withColumn("pct_lost", safe_ratio(100 * (F.col("n_before") - F.col("n_after")), F.col("n_before"))).where(F.col("pct_lost") > percent)


def missing_categories(df: DataFrame, day: str, category: str, expected: list[str]) -> DataFrame:
    """(day, category) pairs that should be there; ``expected`` is a short fixed list."""
    want = df.select(day).distinct().withColumn(category, F.explode(F.array(*map(F.lit, expected))))
    return want.join(df.select(day, category), [day, category], "left_anti")


def not_monotonic(df: DataFrame, keys: list[str], order: list[str], col: str) -> DataFrame:
    before = F.lag(col).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("before", before).where(F.col(col) < F.col("before"))


def partial_nulls(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Groups in which some values are null and some are not."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count(col).alias("n_known")).where("n_known > 0 and n_known < n_rows")


def several_values(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(col).alias("n_values"), join_text(col, ", ", distinct=True).alias("found")).where("n_values > 1")


def signatures(df: DataFrame, keys: list[str], item: str, order: str) -> DataFrame:
    """(keys, n, signature): how many items a group has, and a 128-bit hash of them in their order (equal places by the item's text).

    The place of an item comes from a window, whose sort spills, and the hash from a partial aggregate, so a group of any
    size needs constant memory; no text of a group is made.  Null items have no place.
    """
    text = F.col(item).cast("string")
    place = F.when(text.isNotNull(), F.count(text).over(Window.partitionBy(*keys).orderBy(order, text.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)))
    rows = df.select(*keys, text.alias("_item"), place.alias("_place"))
    halves = (F.coalesce(F.bit_xor(F.when(F.col("_place").isNotNull(), F.xxhash64(*h))), F.lit(0)).cast("bigint") for h in (("_place", "_item"), (F.lit("ordered"), "_item", "_place")))
    return rows.groupBy(*keys).agg(F.count("_place").alias("n"), F.struct(*(h.alias(n) for h, n in zip(halves, ("a", "b"), strict=True))).alias("signature"))


def several_signatures(df: DataFrame, key: str, member: str, item: str, order: str) -> DataFrame:
    """Keys whose members do not all have the same ordered items, and how many orders there are."""
    signs = signatures(df, [key, member], item, order)
    return signs.groupBy(key).agg(F.count_distinct("n", "signature").alias("n_signatures")).where("n_signatures > 1")


def small_groups(df: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") < least)


def unmatched_ids(df: DataFrame, col: str, known: DataFrame, known_col: str, day: str) -> DataFrame:
    """Ids that the reference does not have, with their rows and first and last day."""
    return relationships(df, col, known, known_col).groupBy(col).agg(F.count("*").alias("n_rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def mismatches(df: DataFrame, ref: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Rows whose value is not the reference's, and how."""
    both = df.join(ref.select(*keys, F.col(col).alias("expected"), F.lit(True).alias("_known")), keys, "left")
    kind = F.when(F.col("_known").isNull(), "no reference").when(F.col(col).isNull(), "missing").when(F.col(col) != F.col("expected"), "different")
    return both.withColumn("mismatch", kind).where("mismatch is not null").drop("_known")


def dropped_with_activity(before: DataFrame, after: DataFrame, keys: list[str], activity: Column) -> DataFrame:
    return before.where(activity).join(after.select(*keys), keys, "left_anti")


def outside_band(df: DataFrame, a: str, b: str, low: float = 0.5, high: float = 1.5, least: float = 20) -> DataFrame:
    ratio = F.try_divide(F.col(a), F.col(b))
    return df.where((~ratio.between(low, high) | F.coalesce(F.col(b) == 0, F.lit(False))) & (F.abs(F.col(a) - F.col(b)) > least))


def written_count(stored: DataFrame, where: Column, reported: int) -> DataFrame:
    """One row if the window does not hold as many rows as the write report says."""
    return stored.where(where).agg(F.count("*").alias("n_stored")).withColumn("n_reported", F.lit(reported).cast("bigint")).where("n_stored <> n_reported")
