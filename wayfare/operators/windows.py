"""Ordered operators.  Orders end in a unique column, so results are repeatable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wayfare.functions.casts import as_column
from wayfare.functions.keys import differs

Order = Sequence[Column | str]


def over(keys: Sequence[str], order: Order = ()) -> WindowSpec:
    w = Window.partitionBy(*keys)
    return w.orderBy(*order) if order else w


def to_here(keys: Sequence[str], order: Order) -> WindowSpec:
    return over(keys, order).rowsBetween(Window.unboundedPreceding, 0)


def from_here(keys: Sequence[str], order: Order) -> WindowSpec:
    return over(keys, order).rowsBetween(0, Window.unboundedFollowing)


def keep_first(df: DataFrame, keys: list[str], order: Order, tie: str) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(over(keys, [*order, tie]))).where("_n = 1").drop("_n")


top1 = keep_first


def flag_ends(df: DataFrame, keys: list[str], order: list[str], tie: str) -> DataFrame:
    up = over(keys, [*order, tie])
    down = over(keys, [F.desc(c) for c in (*order, tie)])
    return df.withColumns({"is_first": F.row_number().over(up) == 1, "is_last": F.row_number().over(down) == 1})


def previous(col: Column | str, keys: Sequence[str], order: Order) -> Column:
    return F.lag(as_column(col)).over(over(keys, order))


def close_intervals(df: DataFrame, keys: list[str], start: str, default_end: Column, tie: str, out: str = "valid_to") -> DataFrame:
    """Each version ends where the next one starts."""
    return df.withColumn(out, F.coalesce(F.lead(start).over(over(keys, [start, tie])), default_end))


def running_sum(col: Column | str, keys: Sequence[str], order: Order) -> Column:
    return F.sum(as_column(col)).over(to_here(keys, order))


def group_min(col: Column | str, keys: Sequence[str]) -> Column:
    return F.min(as_column(col)).over(over(keys))


def group_count(keys: Sequence[str]) -> Column:
    return F.count("*").over(over(keys))


def fill_down(col: Column | str, keys: Sequence[str], order: Order) -> Column:
    return F.last(as_column(col), ignorenulls=True).over(to_here(keys, order))


def fill_up(col: Column | str, keys: Sequence[str], order: Order) -> Column:
    return F.first(as_column(col), ignorenulls=True).over(from_here(keys, order))


def fill_both(col: Column | str, keys: Sequence[str], order: Order) -> Column:
    return F.coalesce(as_column(col), fill_down(col, keys, order), fill_up(col, keys, order))


def gap_sessions(df: DataFrame, keys: list[str], ts: str, gap_seconds: int, tie: str) -> DataFrame:
    """``session`` (from 1) and ``session_start``; a gap of the limit or more starts a new one."""
    order = [ts, tie]
    before = F.lag(ts).over(over(keys, order))
    seconds = lambda c: F.unix_micros(c.cast("timestamp")) / 1_000_000
    new = F.when(before.isNull() | (seconds(F.col(ts)) - seconds(before) >= gap_seconds), 1).otherwise(0)
    out = df.withColumn("_new", new).withColumn("session", running_sum("_new", keys, order)).drop("_new")
    return out.withColumn("session_start", F.min(ts).over(over([*keys, "session"])))


def visit_index(df: DataFrame, keys: list[str], item: str, order: Order, tie: str) -> DataFrame:
    """``visit`` rises by one whenever the item differs from the row before's."""
    o = [*order, tie]
    first = F.row_number().over(over(keys, o)) == 1
    step = F.when(first | differs(F.col(item), F.lag(item).over(over(keys, o))), 1).otherwise(0)
    return df.withColumn("_step", step).withColumn("visit", running_sum("_step", keys, o)).drop("_step")


def guarded_delta(col: str, keys: Sequence[str], order: Order, factor: float = 1.0) -> Column:
    """Growth since the row before; NULL where the figure fell or did not change."""
    before = previous(col, keys, order)
    return F.when(F.col(col) > before, (F.col(col) - before) * factor)


def balance_check(df: DataFrame, keys: list[str], order: list[str], tie: str, plus: str, minus: str, level: str) -> DataFrame:
    """Per group: rows whose level is not what went on less what went off, negative levels, and non-zero ends."""
    flagged = flag_ends(df, keys, order, tie).withColumn("_sum", running_sum(F.coalesce(plus, F.lit(0)) - F.coalesce(minus, F.lit(0)), keys, [*order, tie]))
    return flagged.groupBy(*keys).agg(
        F.count_if(F.col(level) != F.col("_sum")).alias("n_unbalanced"),
        F.count_if(F.col(level) < 0).alias("n_negative"),
        F.max(F.when(F.col("is_first"), F.col(level) - F.coalesce(plus, F.lit(0)) + F.coalesce(minus, F.lit(0)) != 0)).alias("starts_loaded"),
        F.max(F.when(F.col("is_last"), F.col(level) != 0)).alias("ends_loaded"),
    )


def first_seen(df: DataFrame, keys: list[str], item: str, order: Order, tie: str) -> DataFrame:
    """``seen_rank`` of the item within its keys, NULL for a null item; ``is_first_seen`` for rank 1."""
    rank = F.when(F.col(item).isNotNull(), F.row_number().over(over([*keys, item], [*order, tie])))
    return df.withColumn("seen_rank", rank).withColumn("is_first_seen", F.coalesce(F.col("seen_rank") == 1, F.lit(False)))


def suffix_duplicates(df: DataFrame, id_col: str, order: Order, tie: str, out: str) -> DataFrame:
    """The id, then ``id-2``, ``id-3`` and so on for its repeats."""
    n = F.row_number().over(over([id_col], [*order, tie]))
    return df.withColumn(out, F.when(n == 1, F.col(id_col).cast("string")).otherwise(F.concat_ws("-", F.col(id_col).cast("string"), n.cast("string"))))


def flag_duplicates(df: DataFrame, keys: list[str], tie: str) -> DataFrame:
    return df.withColumns({"is_duplicate": group_count(keys) > 1, "is_keeper": F.row_number().over(over(keys, [tie])) == 1})
