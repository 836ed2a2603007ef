"""Operators that must stay whole and light at any size: range joins, fused checks, signatures, stop numbers in place."""

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from wayfare.operators.joins import as_of_version, cover, match_ranges
from wayfare.plans import bus, checks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def ranges():
    rng, day = random.Random(2), date(1960, 1, 1)
    out = []
    for i in range(300):
        a = day + timedelta(days=rng.randrange(30_000))
        b = rng.choice([date(9999, 12, 31), a, a - timedelta(days=1), a + timedelta(days=rng.choice([1, 30, 31, 32, 400, 9000, 60_000]))])
        out.append((i, rng.choice("xyz"), a, b))
    return [*out, (300, "x", None, day), (301, "x", day, None), (302, "y", date(1, 1, 1), date(9999, 12, 31)), (303, "z", date(1969, 12, 31), date(1970, 1, 1))]


def test_ranges_of_any_length(spark, ranges):
    rng = random.Random(3)
    points = [(i, rng.choice("xyz"), date(1950, 1, 1) + timedelta(days=rng.randrange(40_000))) for i in range(400)] + [(400, "y", date(9999, 12, 31)), (401, "y", None), (402, "z", date(1970, 1, 1))]
    p, r = spark.createDataFrame(points, "p long, k string, at date"), spark.createDataFrame(ranges, "r long, k string, a date, b date")
    for on in ((), ("k",)):
        left = p if on else p.withColumnRenamed("k", "own")
        got = sorted((x.p, x.r) for x in match_ranges(left, r, "at", "a", "b", on).collect())
        assert got == sorted((i, j) for i, k, at in points for j, h, a, b in ranges if at and a and b and a <= at <= b and (k == h or not on))
    version = as_of_version(p, r, ["p"], "at", "a", "b", [F.desc("a"), F.desc("r")], on=("k",)).collect()
    want = {i: max((a, j) for j, h, a, b in ranges if at and a and b and a <= at <= b and k == h)[1] for i, k, at in points if any(at and a and b and a <= at <= b and k == h for _, h, a, b in ranges)}
    assert {x.p: x.r for x in version} == want


def test_a_cover_is_short_and_exact(spark, ranges):
    rows = [r for r in ranges if r[2] and r[3] and r[2] <= r[3]]
    got = spark.createDataFrame(rows, "r long, k string, a date, b date").select("r", "a", "b", cover(F.col("a"), F.col("b")).alias("c")).collect()
    for r in got:
        low, high = (r.a - date(1970, 1, 1)).days, (r.b - date(1970, 1, 1)).days
        spans = sorted((x.block << (5 + 2 * x.level), (x.block + 1) << (5 + 2 * x.level)) for x in r.c)
        assert spans[0][0] <= low < spans[0][0] + 32 and spans[-1][1] - 32 <= high < spans[-1][1]
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert len(r.c) < 60 and (r.b.year < 9999 or r.a.year < 1900 or len(r.c) < 40)
        assert (r.b - r.a).days > 90 or len(r.c) <= 4


def test_many_checks_are_one_scan(spark, tmp_path):
    spark.range(1000).selectExpr("if(id % 10 = 0, null, id) v", "cast(id % 4 as string) k", "id").write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    bad = {"a": checks.is_null("v"), "b": checks.not_accepted("k", ["0", "1"]), "c": checks.out_of_range("id", 10, 900), "d": checks.is_false("v > 5"), "e": checks.is_null("v", "k = '0'"), **{f"x{i}": checks.out_of_range("id", i) for i in range(5)}}
    own = [checks.Check(n, table=t, fails=f, severity="error") for n, f in bad.items()]
    out = checks.summarise([*own, checks.Check("twice", checks.unique(t, "k"))])
    assert {r.check: (r.severity, r.failures) for r in out.collect()} == {**{c.name: ("error", c.failing.count()) for c in own}, "twice": ("warn", 4)}
    assert len(re.findall("FileScan|Scan parquet", plan(checks.summarise(own)).replace("FileScan parquet", "FileScan"))) == 1
    with pytest.raises(ValueError):
        checks.Check("none")


def test_signatures_need_no_texts(spark):
    rows = [(k, m, i, o) for k, ms in {"same": ["abc", "abc"], "order": ["abc", "acb"], "longer": ["aa", "aaa"], "null": ["a b", "ab"], "ties": ["aab", "aab"]}.items() for m, items in enumerate(ms) for o, i in enumerate(items)]
    df = spark.createDataFrame([(k, m, None if i == " " else i, o * (m + 1) if k != "ties" else 0) for k, m, i, o in rows], "k string, m long, i string, o long").repartition(5)
    out = checks.several_signatures(df, "k", "m", "i", "o")
    assert {(r.k, r.n_signatures) for r in out.collect()} == {("order", 2), ("longer", 2)}
    assert "collect_list" not in plan(out) and "ObjectHashAggregate" not in plan(out)


def test_stop_numbers_in_place(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["t1", "t2", None]), rng.choice(["s1", "s2", "s3", None]), rng.choice(["Scheduled", "Skipped", "Added"]), rng.choice([None, 0, -1, 1, 2]), f"2024-01-01 {rng.randrange(6, 9):02d}:{rng.randrange(60):02d}:00") for i in range(400)]
    loc = spark.createDataFrame(rows, "location_ping_id long, trip_id_performed_imputed string, stop_id_imputed string, schedule_relationship string, trip_stop_sequence int, ts string")
    loc = loc.select("*", F.col("ts").cast("timestamp").alias("event_timestamp"), F.lit("2024-01-01").cast("date").alias("service_date")).repartition(3)
    joined, placed = bus.fill_stop_sequence(loc, bus.index_stop_sequence(loc)), bus.fill_stop_sequence(loc)
    read = lambda df: {r.location_ping_id: r.trip_stop_sequence_imputed for r in df.collect()}
    assert read(placed) == read(joined) and sum(v is not None for v in read(placed).values()) > 100
    assert set(placed.columns) == set(joined.columns)
    text = plan(bus.fill_stop_sequence(loc))
    assert "Join" not in text and text.count("hashpartitioning") == 1
