"""Streaming twins give what the batch operators give, over several batches, in any order, with late rows."""

import random
import time

import pytest
from pyspark.sql import functions as F

from wayfare.operators.windows import first_seen, gap_sessions
from wayfare.sources import writers
from wayfare.streaming.incremental import tumbling
from wayfare.streaming.streams import hourly_to, stream_first_seen, stream_hourly, stream_sessions


def ran(df, tmp_path, put, mode="append"):
    q = df.writeStream.outputMode(mode).foreachBatch(put).trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    q.awaitTermination(120)
    assert not q.exception()
    return [p for p in q.recentProgress]


def as_stream(spark, tmp_path, schema, batches):
    """A stream of which every batch is one file; rows of another year let the watermark pass all."""
    for rows in [*batches, [(0, "2030-01-01 00:00:00", "end")], [(0, "2030-01-02 00:00:00", "end")]]:
        df = spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.02)
    whole = spark.createDataFrame([r for b in batches for r in b], schema).withColumn("ts", F.col("ts").cast("timestamp"))
    return whole, spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")


def collected(df, tmp_path, mode="append"):
    out = []
    ran(df, tmp_path, lambda batch, n: out.extend(batch.collect()), mode)
    return out


SCHEMA = "id long, ts string, k string"


@pytest.fixture
def shuffled():
    """Events of four keys in sub-second steps, some at exactly the gap, dealt to four batches: mostly by time, some late, some early."""
    rng, rows = random.Random(4), []
    for k in ("a", "b", "c", None):
        at = 0
        for _ in range(60):
            at += rng.choice([0, 1, 999_999, 1_000_000, 2_500_000, 3_599_999_999, 3_600_000_000, 3_600_000_001, 9_000_000_000])
            rows.append((len(rows), at, k))
    top = max(r[1] for r in rows)
    text = lambda us: f"2024-01-{1 + us // 86_400_000_000:02d} {us // 3_600_000_000 % 24:02d}:{us // 60_000_000 % 60:02d}:{us // 1_000_000 % 60:02d}.{us % 1_000_000:06d}"
    batches = [[], [], [], []]
    for i, at, k in rows:
        batches[min(3, max(0, at * 4 // top + rng.choice([-1, 0, 0, 0, 1])))].append((i, text(at), k))
    return [rng.sample(b, len(b)) for b in batches]


def test_sessions(spark, tmp_path, shuffled):
    whole, stream = as_stream(spark, tmp_path, SCHEMA, shuffled)
    want = gap_sessions(whole, ["k"], "ts", 3600, "id").groupBy("k", "session_start").agg(F.count("*").alias("n"), F.max("ts").alias("end")).collect()
    got = [r for r in collected(stream_sessions(stream, ["k"], "ts", 3600, "40 hours"), tmp_path) if r.session_start.year == 2024]
    assert sorted((r.k or "", r.session_start, r.session_end, r.n) for r in got) == sorted((r.k or "", r.session_start, r.end, r.n) for r in want)


def test_sessions_leave_the_state(spark, tmp_path, shuffled):
    _, stream = as_stream(spark, tmp_path, SCHEMA, shuffled)
    progress = ran(stream_sessions(stream, ["k"], "ts", 3600, "1 hour"), tmp_path, lambda batch, n: batch.count())
    assert progress[-1].stateOperators[0].numRowsTotal <= 1  # of the last row alone
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in progress) > 0


@pytest.mark.parametrize("forget", [None, 86_400])
def test_first_seen(spark, tmp_path, shuffled, forget):
    whole, stream = as_stream(spark, tmp_path, SCHEMA, shuffled)
    want = {(r.k, r.id, r.ts) for r in first_seen(whole, [], "k", ["ts"], "id").where("is_first_seen").collect()}
    got = [r for r in collected(stream_first_seen(stream, ["k"], "ts", "id", "40 hours", forget), tmp_path) if r.k != "end"]
    if forget is None:
        assert {(r.k, r.id, r.ts) for r in got} == want and len(got) == len(want) == 3
    else:
        assert {(r.k, r.id, r.ts) for r in got} >= want


def test_first_is_not_the_first_to_arrive(spark, tmp_path):
    batches = [[(5, "2024-01-01 09:00:00", "x"), (6, "2024-01-01 09:00:00", "y")], [(3, "2024-01-01 07:00:00", "x"), (2, "2024-01-01 09:00:00", "y")], [(1, "2024-01-01 08:00:00", "x"), (9, "2024-01-05 00:00:00", "x")]]
    _, stream = as_stream(spark, tmp_path, SCHEMA, batches)
    got = collected(stream_first_seen(stream, ["k"], "ts", "id", "6 hours"), tmp_path)
    assert sorted((r.k, r.id) for r in got if r.k != "end") == [("x", 3), ("y", 2)]


def test_hourly_into_a_table(spark, tmp_path, shuffled):
    whole, stream = as_stream(spark, tmp_path, SCHEMA, shuffled)
    target, put, batches = f"{tmp_path}/t", hourly_to(f"{tmp_path}/t", ["k"], "live"), []

    def each(batch, n):
        kept = spark.createDataFrame(batch.collect(), batch.schema)
        batches.append((kept, n))
        put(batch, n)

    progress = ran(stream_hourly(stream, "ts", ["k"], "40 hours", ("id",)), tmp_path, each, "update")
    want = {(r.hour, r.k, r.n, r.id) for r in whole.groupBy(F.date_trunc("hour", "ts").alias("hour"), "k").agg(F.count("*").alias("n"), F.sum("id").alias("id")).collect()}
    read = lambda: [(r.hour, r.k, r.n, r.id) for r in writers.stored(spark, target).where("year(hour) = 2024").collect()]
    assert set(read()) == want and len(read()) == len(want) and len(batches) >= 5
    assert writers.partition_columns(spark, target) == ["hour_day"] and progress[-1].stateOperators[0].numRowsTotal <= 8 < len(want)
    files = {x[2] for x in writers.data_files(spark, target)}
    for batch, n in (batches[-1], batches[1]):  # a batch runs again, and one that later ones have overtaken
        put(batch, n)
    assert files == {x[2] for x in writers.data_files(spark, target)}
    hourly_to(target, ["k"], "other")(batches[0][0], 0)
    assert len(read()) == len(want)


def test_tumbling(spark):
    batch = spark.createDataFrame([(f"2024-01-01 {h:02d}:{m:02d}:00",) for h, m in [(1, 0), (1, 30), (2, 30), (3, 29), (5, 0)]], "ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    starts = {r.window_start.hour for r in tumbling(batch, "ts", "2 hours").collect()}
    assert starts == {0, 2, 4}
