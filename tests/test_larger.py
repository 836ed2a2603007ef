"""What larger tables bring: against the SQL of the registered queries, and by the shape of plans."""

import random
import re
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.test_registry import rows
from wayfare.functions.places import rounded
from wayfare.llm import hamming
from wayfare.operators import joins
from wayfare.plans import catalog_chains, catalog_loads, schedule
from wayfare.streaming import streams


def against_sql(spark, folder, name, *tables):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df, want = entry.queries()[name](spark, str(folder)), con.sql(entry.oracle_sql()[name])
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows(want.columns, want.fetchall())
    return got


@pytest.fixture
def dense(spark, tmp_path):
    """Events of a few users within a few seconds, some at the same microsecond."""
    rng, start = random.Random(7), datetime(2024, 1, 5, 10)
    out = [(i, start + timedelta(microseconds=rng.choice([0, 1, 250_000, 999_999]) + 1_000_000 * rng.randrange(6)), rng.randrange(8), rng.choice("abc"), float(i), "{}") for i in range(600)]
    spark.createDataFrame(out, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    return tmp_path


@pytest.mark.parametrize("name", ["D-B16_vehicle_locations_realtime", "D-B17_stop_visits_realtime"])
def test_first_positions_within_a_second(spark, dense, name):
    assert len(against_sql(spark, dense, name, "events")) >= 12


def test_no_segment_is_much_narrower_than_the_others(spark):
    for n in (0, 2, 300, 2000, 50_000, 720_000, 10**7, 10**12):
        for dims in (1, 7, 64, 100, 128, 1000):
            parts = hamming.cuts(n, dims)
            widths = [w for _, w in parts]
            assert [s for s, _ in parts] == [sum(widths[:i]) for i in range(len(parts))] and sum(widths) == dims
            assert max(widths) - min(widths) <= 1 and max(widths) <= 30
    # a probe of a narrow last segment would find a sixteenth of all codes
    assert hamming.probed(hamming.cuts(720_000, 64), 0, 720_000) < 100


@pytest.mark.parametrize("dims", [64, 70, 64 * hamming.FLAT + 1])
def test_search_over_uneven_bits(spark, monkeypatch, dims):
    monkeypatch.setattr(hamming, "PAIRS", 200)  # several tasks
    rng = np.random.default_rng(dims)
    n = 600 if dims < 100 else 60
    x = rng.standard_normal((n, dims)).astype("float32")
    x[n // 2 : n // 2 + n // 6] = x[: n // 6]
    x[n // 2 : n // 2 + n // 12, 3] *= -1
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.distance) for r in hamming.search(vectors, F.col("vec_id") % 20 == 0, 5).collect())
    apart = ((x > 0)[:, None, :] != (x > 0)[None, :, :]).sum(2)
    want = [(q, k + 1, i, d) for q in range(0, n, 20) for k, (d, i) in enumerate(sorted((int(apart[q, i]), i) for i in range(n) if i != q)[:5])]
    assert got == want


@pytest.fixture
def places(spark):
    """Pings and stops of three keys, most of them of one; some without a key, a place or a partner."""
    rng = random.Random(11)
    at = lambda: (rng.choice([None, 38.9, 38.9 + rng.randrange(40) / 10_000]), -77.0 + rng.randrange(40) / 10_000)
    key = lambda: rng.choice(["a"] * 8 + ["b", None])
    pings = spark.createDataFrame([(i, rng.choice([key(), "c"]), *at(), rng.randrange(7)) for i in range(500)], "ping long, k string, lat double, lon double, seq int")
    stops = spark.createDataFrame([(i, rng.choice([key(), "d"]), *at(), rng.randrange(7)) for i in range(300)], "stop long, k string, s_lat double, s_lon double, s_seq int")
    return pings, stops


ON = (["k"], ("lat", "lon"), ("s_lat", "s_lon"))


@pytest.mark.parametrize("pairs", [500, 10**9])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_dealt_pairs(spark, monkeypatch, places, pairs, how):
    pings, stops = places
    monkeypatch.setattr(joins, "PAIRS", pairs)
    read = lambda df: sorted((r.ping, -1 if r.stop is None else r.stop) for r in df.collect())
    want = pings.join(stops, "k", how)
    out = joins.dealt(pings, stops, ["k"], how)
    assert read(out) == read(want) and out.columns == want.columns
    tasks = [r[1] for r in out.where("stop is not null").groupBy(F.spark_partition_id()).count().collect()]
    assert pairs > 500 or max(tasks) < 6 * pairs < sum(tasks) / 5
    box, plain = joins.dealt_box(pings, stops, *ON, how=how), joins.within_box(pings, stops, *ON)
    assert read(box) == read(plain if how == "left" else plain.where("stop is not null"))


def test_nearest_among_shared_keys(spark, monkeypatch, places):
    pings, stops = places
    monkeypatch.setattr(joins, "PAIRS", 500)
    for steps in (None, F.abs(F.col("seq") - F.col("s_seq")), F.col("seq") - F.col("s_seq")):
        plain, shared = (joins.nearest(pings, stops, *ON, "ping", "stop", "stop", steps=steps, shared=x).collect() for x in (False, True))
        assert sorted(plain, key=lambda r: r.ping) == sorted(shared, key=lambda r: r.ping) and sum(r.stop is not None for r in plain) > 100


def test_rounded_as_the_sql_rounds(spark):
    rng = random.Random(2)
    xs = [0.0, -0.0, 0.0005, 0.0015, 1.0005, 2.5, -0.0005, -7.1235, 1e9 + 0.0005, *(rng.uniform(-1e5, 1e5) for _ in range(500)), *(rng.randrange(10**6) / 2000 for _ in range(500))]
    got = [r.x for r in spark.createDataFrame([(x,) for x in xs], "v double").select(rounded(F.col("v"), 3).alias("x")).collect()]
    assert got == [r[0] for r in duckdb.execute("SELECT round(v, 3) FROM (SELECT unnest(?) AS v)", [xs]).fetchall()]


def test_trips_become_days_last(spark):
    """No shuffle or sort stands between the days of a trip and the result."""
    n = catalog_chains.network(spark, "/root/testdata/sf0.001")
    text = schedule.scheduled_stop_times(n["running"], n["times"], n["stops"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in text and not re.search("Join|Aggregate", text[: text.index("Generate")])
    by_day = schedule.scheduled_stop_times(n["trips"], n["times"], n["stops"])
    by_trip = schedule.scheduled_stop_times(n["running"], n["times"], n["stops"])
    assert sorted(by_day.columns) == sorted(by_trip.columns) and by_trip.count() > 5000
    assert by_day.select(*by_trip.columns).exceptAll(by_trip).isEmpty() and by_trip.exceptAll(by_day.select(*by_trip.columns)).isEmpty()


@pytest.mark.parametrize("name", ["ST-7_stream_first_event", "ST-7_stream_first_seen"])
def test_batches_of_several_files(spark, dense, monkeypatch, name):
    monkeypatch.setattr(catalog_loads, "A_FILE", 40)
    folders, plain = [], catalog_loads.w.scratch
    monkeypatch.setattr(catalog_loads.w, "scratch", lambda s: (folders.append(plain(s)), folders[-1])[1])
    assert len(against_sql(spark, dense, name, "events")) == 24
    files = spark.read.parquet(folders[0]).groupBy(F.input_file_name()).count().collect()
    assert len(files) % 5 == 0 and len(files) >= 10 and max(n for _, n in files) < 150


def test_first_events_of_many_keys(spark, tmp_path, monkeypatch):
    """Keys share groups; ids over 2**53 stay exact beside nulls."""
    monkeypatch.setattr(streams, "GROUPS", 7)
    rng, big = random.Random(5), 2**60
    rows = [(None if rng.random() < 0.1 else big + i, datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(9000)), rng.randrange(150), rng.choice(["x", "y", None])) for i in range(1500)]
    schema = "id long, ts timestamp, u int, k string"
    end = datetime(2030, 1, 1)
    for batch in [rows[:500], rows[500:1000], rows[1000:], [(0, end, 0, "end")], [(0, end + timedelta(days=1), 0, "end")]]:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = []
    q = streams.stream_first_seen(stream, ["u", "k"], "ts", "id", "7 days").writeStream.foreachBatch(lambda b, n: out.extend(b.collect())).trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    q.awaitTermination(120)
    assert not q.exception()
    want = {}
    for i, at, u, k in rows:
        if k is not None:
            want[u, k] = min(want.get((u, k), (end, False, 0)), (at, i is None, i or 0))
    assert {(r.u, r.k): (r.ts, r.id is None, r.id or 0) for r in out if r.k != "end"} == want and sum(r.k != "end" for r in out) == len(want)
    assert max(p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators) <= 7 < len(want)


@pytest.mark.parametrize("name", ["F-17_in_box", "J-6_within_box"])
def test_boxes_are_dealt_and_in_order(spark, monkeypatch, name):
    """Several tasks share a nation's pairs, and a task's pings come by place, so that like lists of stops are neighbours."""
    monkeypatch.setattr(joins, "PAIRS", 50)
    orders = []
    plain = joins.dealt
    monkeypatch.setattr(joins, "dealt", lambda *a: (orders.append(plain(*a)), orders[-1])[1])
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 30
    here = orders[0].select(F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("n"), "k", "lat", "lon").orderBy("n").collect()
    assert len({r.task for r in here}) > 3
    for task in {r.task for r in here}:
        blocks: dict = {}
        for r in here:
            if r.task == task:
                blocks.setdefault(r.k, []).append((r.lat, r.lon))
        assert all(sum(a > b for a, b in zip(x, x[1:], strict=False)) <= 6 for x in blocks.values())
