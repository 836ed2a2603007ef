"""Surrogate keys, null-skipping extremes, text tests and table names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare.functions.casts import as_column

#: What a surrogate key holds for NULL; fixed value.
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    return F.md5(F.concat_ws("-", *(F.coalesce(as_column(c).cast("string"), F.lit(NULL_KEY)) for c in cols)))


def full_match(c: Column | str, pattern: str) -> Column:
    return as_column(c).rlike(f"^(?:{pattern})$")


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """The group's text; NULL, not blank, without a match."""
    return F.nullif(F.regexp_extract(as_column(c), pattern, group), F.lit(""))


def redacted(c: Column | str, date: Column | str) -> Column:
    return F.sha1(F.concat(as_column(c).cast("string"), F.date_format(as_column(date), "yyyy-MM-dd")))


def differs(a: Column | str, b: Column | str) -> Column:
    return ~as_column(a).eqNullSafe(as_column(b))


def not_in_or_null(c: Column | str, values: list) -> Column:
    return F.coalesce(~as_column(c).isin(values), F.lit(True))


def safe_ratio(a: Column, b: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), digits)


def table_name(env: str, schema: str) -> str:
    """The schema's name in an environment; production has no prefix."""
    return schema if env in ("", "prod") else f"{env}_{schema}"
