"""Streaming twins of the batch operators.

Event times are compared in microseconds, whatever the session's time zone.  Rows that come
later than the watermark allows are left out, as everywhere in Spark.  What a key's state holds is
bounded by what the watermark has not passed yet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType

from wayfare.sources.writers import partition_column, upsert


def _schema(sdf: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {sdf.schema[n].dataType.simpleString()}" for n in names)


def _wake(state: GroupState, micros: int) -> None:
    """Wakes the key once the watermark has passed ``micros``."""
    state.setTimeoutTimestamp(max(micros // 1000, state.getCurrentWatermarkMs() + 1))


#: Keys share so many groups by hash; a group's state is one table of its keys.
GROUPS = 1024


def _packed(held: pd.DataFrame) -> bytes:
    table, out = pa.Table.from_pandas(held, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(data)).read_all().to_pandas()


def stream_first_seen(sdf: DataFrame, keys: list[str], ts: str, tie: str, watermark: str = "1 day", forget_seconds: int | None = None) -> DataFrame:
    """(keys, ts, tie) of the first event of each key, whatever the order of arrival: the rows that ``first_seen`` ranks 1.

    A key's least event is held back until the watermark has passed it, for no earlier one can come
    then.  The key itself is remembered, so that it is never first again; with ``forget_seconds``
    only so long after its first event, which is for keys that do not come back (such as a trip's stops on
    a day), and bounds the state.  Rows with a null key or
    time have no first event, and do not move the watermark.  Keys meet in ``GROUPS`` groups, by hash, as a call of
    Python for each key would cost far more than its rows.
    """
    names = [*keys, "_at", "_none", tie]

    def run(_: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = _unpacked(state.get[0]) if state.exists else None
        for f in frames:
            new = f[names].assign(_told=False)
            new = new if held is None else pd.concat([held, new], ignore_index=True)
            # a key that was told stays as it is
            held = new.sort_values(["_told", "_at", "_none", tie], ascending=[False, True, True, True], kind="stable").drop_duplicates(keys)
        if held is None:
            return
        passed = state.getCurrentWatermarkMs() * 1000
        due = ~held["_told"] & (held["_at"] <= passed)
        if due.any():
            yield held.loc[due, names]
        held = held.assign(_told=held["_told"] | due)
        wakes = held.loc[~held["_told"], "_at"]
        if forget_seconds is not None:
            gone = held["_at"] + forget_seconds * 1_000_000
            held = held[~(held["_told"] & (gone <= passed))]
            wakes = held["_at"] + held["_told"] * forget_seconds * 1_000_000
        if not len(held):
            if state.exists:
                state.remove()
            return
        state.update((_packed(held),))
        if len(wakes):
            _wake(state, int(wakes.min()))

    there = sdf.where(" and ".join(f"{k} is not null" for k in [*keys, ts])).withWatermark(ts, watermark)
    # whole numbers with nulls would become floats
    plain = F.coalesce(tie, F.lit(0).cast(sdf.schema[tie].dataType)) if isinstance(sdf.schema[tie].dataType, IntegralType) else F.col(tie)
    group = F.pmod(F.xxhash64(*keys), F.lit(GROUPS)).alias("_group")
    rows = there.select(*keys, ts, plain.alias(tie), F.col(tie).isNull().alias("_none"), F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"), group)
    out = rows.groupBy("_group").applyInPandasWithState(run, f"{_schema(sdf, keys)}, _at long, _none boolean, {_schema(sdf, [tie])}", "held binary", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(*keys, F.timestamp_micros("_at").alias(ts), F.when(~F.col("_none"), F.col(tie)).alias(tie))


def stream_hourly(sdf: DataFrame, ts: str, keys: list[str], watermark: str = "3 days", sums: tuple[str, ...] = ()) -> DataFrame:
    """Counts and sums by hour and keys; for update mode, in which hours behind the watermark leave the state."""
    out = sdf.withWatermark(ts, watermark).groupBy(F.window(ts, "1 hour"), *keys).agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in sums))
    return out.select(F.col("window.start").alias("hour"), *keys, "n", *sums)


def hourly_to(target: str, keys: list[str], load: str):
    """For ``foreachBatch`` of :func:`stream_hourly`: the hours of a batch take the place of their former figures, day by day.

    The table is partitioned by ``hour_day``.  A batch that runs again changes nothing.
    """
    name, expr = partition_column("hour", "day")

    def put(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.withColumn(name, expr), target, ["hour", *keys], name, load, batch_id)

    return put


def stream_sessions(sdf: DataFrame, keys: list[str], ts: str, gap_seconds: float = 3600, watermark: str = "1 day") -> DataFrame:
    """(keys, n, session_start, session_end): the sessions of ``gap_sessions``, a gap of exactly the limit starting a new one.

    A key holds its open sessions; late rows, within the watermark, extend or join them.  A session is given
    out, and leaves the state, once the watermark is the gap behind its end.
    """
    gap = round(gap_seconds * 1_000_000)

    def run(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spans = list(zip(*state.get, strict=True)) if state.exists else []
        for f in frames:
            spans += [(int(t), int(t), int(n)) for t, n in f["_at"].value_counts().items()]
        joined: list[list[int]] = []
        for start, end, n in sorted(spans):
            if joined and start - joined[-1][1] < gap:
                joined[-1] = [joined[-1][0], max(end, joined[-1][1]), joined[-1][2] + n]
            else:
                joined.append([start, end, n])
        passed = state.getCurrentWatermarkMs() * 1000
        over = [x for x in joined if x[1] + gap <= passed]
        if over:
            yield pd.DataFrame([[*key, n, start, end] for start, end, n in over], columns=[*keys, "n", "_start", "_end"])
        if left := [x for x in joined if x[1] + gap > passed]:
            state.update(tuple(list(x) for x in zip(*left, strict=True)))
            _wake(state, min(x[1] for x in left) + gap)
        elif state.exists:
            state.remove()

    there = sdf.where(F.col(ts).isNotNull()).withWatermark(ts, watermark)
    rows = there.select(*keys, ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"))
    out = rows.groupBy(*keys).applyInPandasWithState(run, f"{_schema(sdf, keys)}, n long, _start long, _end long", "starts array<long>, ends array<long>, counts array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(*keys, "n", F.timestamp_micros("_start").alias("session_start"), F.timestamp_micros("_end").alias("session_end"))
