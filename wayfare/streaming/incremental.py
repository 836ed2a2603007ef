"""Repeatable loads: recompute whole days, replace them, leave the others."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.times import utc_to_local
from wayfare.sources.writers import write


def windowed_inputs(inputs: dict[str, tuple[DataFrame, bool]], event_col: str, start: date, end: date) -> dict[str, DataFrame]:
    """Inputs cut to [start, end) by event time; those declared as not windowed stay whole."""
    inside = (F.col(event_col) >= F.lit(start).cast("date")) & (F.col(event_col) < F.lit(end).cast("date"))
    return {name: df.where(inside) if windowed else df for name, (df, windowed) in inputs.items()}


def incremental_overwrite(build: Callable[..., DataFrame], inputs: dict[str, tuple[DataFrame, bool]], target: str, event_col: str, start: date, end: date, lookback_days: int = 3, floor: date | None = None, per_day: bool = False) -> list[tuple[date, date]]:
    """Builds [start - look-back, end) and replaces those days, also those for which nothing was built.

    The table is partitioned by ``event_col``.  Running it again changes nothing.
    """
    first = max(start - timedelta(days=lookback_days), floor or date.min)
    days = [first + timedelta(days=i) for i in range((end - first).days)]
    spans = [(d, d + timedelta(days=1)) for d in days] if per_day else [(first, end)] if days else []
    for low, high in spans:
        out = build(**windowed_inputs(inputs, event_col, low, high))
        inside = (F.col(event_col) >= F.lit(low).cast("date")) & (F.col(event_col) < F.lit(high).cast("date"))
        write(out.where(inside), target, strategy="time_between", col=event_col, start=low, end=high, by=[event_col])
    return spans


def rolling_window(as_of: date, days_back: int = 8) -> tuple[date, date]:
    """[as_of - days_back, as_of): never the day itself."""
    return as_of - timedelta(days=days_back), as_of


def window_from_key(key: str, as_of: date) -> tuple[date, date]:
    """The window that a key (a day, or two days joined by ``/``) names; an error if it reaches ``as_of``."""
    parts = [date.fromisoformat(p) for p in key.split("/")]
    low, high = (parts[0], parts[0] + timedelta(days=1)) if len(parts) == 1 else (parts[0], parts[1])
    if high > as_of or low >= high:
        raise ValueError(f"window {key!r} is empty or not over yet")
    return low, high


def tumbling(df: DataFrame, ts: str, size: str, tz: str | None = None) -> DataFrame:
    """``window_start`` and ``window_end`` of calendar-aligned windows, in local time with ``tz``."""
    at = utc_to_local(ts, tz) if tz else F.col(ts)
    return df.withColumn("_w", F.window(at.cast("timestamp"), size)).withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")
