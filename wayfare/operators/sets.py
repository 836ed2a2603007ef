"""Unions, splits and unpivots."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators.joins import flag_member


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def transform_where(df: DataFrame, cond: Column, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``fn`` on the rows where ``cond`` holds; the others, and those where it is unknown, pass."""
    return fn(df.where(cond)).unionByName(df.where(~F.coalesce(cond, F.lit(False))))


def unpivot_roles(df: DataFrame, roles: dict[str, str], out: str, role: str = "role") -> DataFrame:
    """A row for each id column that is not null, with the column's role."""
    rest = [c for c in df.columns if c not in roles]
    long = df.unpivot(rest, list(roles), "_column", out).where(F.col(out).isNotNull())
    names = F.create_map(*(F.lit(x) for pair in roles.items() for x in pair))
    return long.withColumn(role, names[F.col("_column")]).drop("_column")


def union_groups(base: DataFrame, merged: DataFrame, key: str) -> DataFrame:
    """Rows and their merged groups in one table; rows that a group absorbed are flagged."""
    flagged = flag_member(base, merged, key, key, "is_absorbed").withColumn("is_group", F.lit(False))
    return union_all(flagged, merged.withColumns({"is_absorbed": F.lit(False), "is_group": F.lit(True)}))


def with_today(history: DataFrame, live: DataFrame | None, date_col: str, as_of: str) -> DataFrame:
    """History, and today's live rows if there are any."""
    return history if live is None else history.unionByName(live.where(F.col(date_col) == F.lit(as_of).cast("date")), allowMissingColumns=True)
