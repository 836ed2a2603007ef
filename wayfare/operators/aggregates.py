"""Grouped figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.casts import as_column
from wayfare.functions.keys import safe_ratio


def agg(df: DataFrame, keys: list[str], having: str | None = None, **aggs: Column) -> DataFrame:
    out = df.groupBy(*keys).agg(*(c.alias(n) for n, c in aggs.items()))
    return out.where(having) if having else out


def count_distinct(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(col).alias(f"distinct_{col}"))


def first_by(col: Column | str, *order: Column | str) -> Column:
    """The value of the row that comes first; trailing order columns break ties."""
    return F.min_by(as_column(col), F.struct(*order))


def last_by(col: Column | str, *order: Column | str) -> Column:
    return F.max_by(as_column(col), F.struct(*order))


def any_of(col: Column | str) -> Column:
    """One of the group's values, the same in every run."""
    return F.min(as_column(col))


def join_text(col: Column | str, sep: str = ",", distinct: bool = False, order: Column | str | None = None) -> Column:
    c = as_column(col).cast("string")
    if distinct:
        return F.array_join(F.sort_array(F.collect_set(c)), sep)
    pairs = F.sort_array(F.collect_list(F.struct((as_column(order) if order is not None else c).alias("o"), c.alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), sep)


def merge_priority(col: Column | str, ranked: list[str]) -> Column:
    """The highest ranked value of the group; the smallest other value if none is ranked."""
    c = as_column(col)
    rank = F.array_position(F.array(*map(F.lit, ranked)), c)
    return F.min_by(c, F.struct(F.when(rank > 0, rank).otherwise(len(ranked) + 1), c))


def any_true(col: Column | str) -> Column:
    return F.bool_or(as_column(col))


def distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def mode(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """The most frequent value that is not null; the smallest of equally frequent ones."""
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(col, F.struct(-F.col("_n"), F.col(col))).alias(f"mode_{col}"))


def first_last(df: DataFrame, keys: list[str], col: str, order: list[str], tie: str) -> DataFrame:
    return df.groupBy(*keys).agg(first_by(col, *order, tie).alias(f"first_{col}"), last_by(col, *order, tie).alias(f"last_{col}"))


def roll_up(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))


def null_rate(df: DataFrame, keys: list[str], col: str, threshold: float) -> DataFrame:
    """Groups in which more than ``threshold`` percent of the values are null."""
    n, nulls = F.count("*"), F.count_if(F.col(col).isNull())
    return df.groupBy(*keys).agg(n.alias("n_rows"), nulls.alias("n_null"), safe_ratio(100 * nulls, n).alias("pct_null")).where(F.col("pct_null") > threshold)
