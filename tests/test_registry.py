"""Every registered transit query against its SQL on the smallest tables."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.SQL if n in entry.QUERIES]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def rows(names, data):
    order = sorted(names)
    out = [tuple(value(dict(zip(names, r, strict=True))[n]) for n in order) for r in data]
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    df = entry.QUERIES[name](spark, SF)
    want = con.sql(entry.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_whole_tables(spark):
    orders, customers = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "customer"))
    got = {n: entry.QUERIES[n](spark, SF) for n in NAMES if n.endswith("_whole")}
    assert len(got) == 5
    assert got["D-G9_calendar_exceptions_whole"].count() == orders.count()
    assert got["D-G8_calendar_long_whole"].select("service_id").distinct().count() == orders.count()
    keys = [r.o_custkey for r in orders.select("o_custkey").distinct().collect()]
    for n in ("J-5_match_ranges_whole", "J-13_as_of_version_whole"):
        rows = got[n].collect()
        assert max(r.point for r in rows) > 40 and {r.point for r in rows} <= set(keys) and len(rows) <= 2 * customers.count()


def test_names():
    assert all(re.match(r"[A-Z]+(-[A-Z]*\d+)+_|op\d+_|pipeline", n) for n in entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
