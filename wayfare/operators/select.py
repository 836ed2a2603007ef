"""Projections, filters and classification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfare.functions.casts import as_column, flex_cast
from wayfare.functions.keys import redacted


def stage(df: DataFrame, spec: list[tuple[str, str, str, bool]]) -> DataFrame:
    """One projection from (source, name, type, safe) entries."""
    return df.select(*(flex_cast(src, kind, safe).alias(dst) for src, dst, kind, safe in spec))


def select_except(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns, order and types of ``schema``; typed NULLs where ``df`` has none."""
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def classify(rules: list[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first rule that holds."""
    out = reduce(lambda acc, r: acc.when(r[0], F.lit(r[1])), rules[1:], F.when(rules[0][0], F.lit(rules[0][1])))
    return out.otherwise(F.lit(default))


def redact(df: DataFrame, cols: list[str], date_col: str, query_cols: list[str]) -> DataFrame:
    """``query_cols`` plain and ``cols`` as digests salted with the row's date."""
    if both := sorted({*cols} & {*query_cols}):
        raise ValueError(f"redacted columns are also selected plainly: {both}")
    if date_col not in df.columns:
        raise ValueError(f"no date column {date_col!r}")
    return df.select(*query_cols, *(redacted(c, date_col).alias(c) for c in cols))


def keep_valid(df: DataFrame, flag: str = "is_valid") -> DataFrame:
    return df.where(F.col(flag))


def recent(df: DataFrame, col: str, as_of: str, days: int) -> DataFrame:
    end = F.lit(as_of).cast("date")
    return df.where(F.col(col).cast("date").between(F.date_sub(end, days), end))


def validity(df: DataFrame, checks: list[tuple[str, Column, str]]) -> DataFrame:
    """A flag per check, ``is_valid`` if all hold (NULL if unknown), and the first failure's reason."""
    out = df.withColumns({flag: cond for flag, cond, _ in checks})
    flags = [F.col(flag) for flag, _, _ in checks]
    reason = classify([(~F.col(flag), text) for flag, _, text in checks])
    return out.withColumn("is_valid", reduce(lambda a, b: a & b, flags)).withColumn("invalid_reason", reason)


def sort(df: DataFrame, order: list[Column]) -> DataFrame:
    return df.orderBy(*order)


def nulls_last(c: Column | str) -> Column:
    return as_column(c).asc_nulls_last()


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)
