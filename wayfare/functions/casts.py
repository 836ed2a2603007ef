"""Tolerant casts and guarded parsing; each takes and returns Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: POSIX directives and their Java pattern letters; fixed values.
JAVA_TOKENS = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%A": "EEEE", "%j": "DDD", "%b": "MMM", "%p": "a", "%I": "hh"}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flex_cast(c: Column | str, kind: str, safe: bool = False) -> Column:
    """Blank strings count as NULL; ``safe`` gives NULL instead of an error."""
    text = F.nullif(F.trim(as_column(c).cast("string")), F.lit(""))
    return text if kind == "string" else text.try_cast(kind) if safe else text.cast(kind)


def nan_like(c: Column | str) -> Column:
    return F.lower(as_column(c).cast("string")).isin("nan", "inf", "-inf", "infinity", "-infinity")


def java_format(posix: str) -> str:
    """A POSIX time format as a Java pattern; unknown directives are errors."""
    out, i = "", 0
    while i < len(posix):
        if posix[i] == "%":
            if (token := posix[i : i + 2]) not in JAVA_TOKENS:
                raise ValueError(f"unsupported time directive {token!r}")
            out, i = out + JAVA_TOKENS[token], i + 2
        else:
            out, i = out + (f"'{posix[i]}'" if posix[i].isalpha() else posix[i]), i + 1
    return out


def parse_datetime(c: Column | str, fmt: str, length: int, kind: str = "timestamp") -> Column:
    """NULL unless the trimmed text has ``length`` characters, is not negative and parses."""
    text = F.trim(as_column(c).cast("string"))
    good = (F.length(text) == length) & ~F.startswith(text, F.lit("-"))
    return F.when(good, F.try_to_timestamp(text, F.lit(java_format(fmt)))).cast(kind)


def as_date(c: Column | str) -> Column:
    return as_column(c).cast("date")


def as_timestamp(c: Column | str) -> Column:
    return as_column(c).cast("timestamp")
