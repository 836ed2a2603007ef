"""Readers, sinks and incremental loads."""

import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wayfare.sources import readers, writers
from wayfare.streaming import incremental


def bundle(path, name, stops):
    with zipfile.ZipFile(path / name, "w") as z:
        for member, body in {"feed_info.txt": "feed_version,feed_start_date\nv1,20240101\n", "stops.txt": stops, "notes.md": "x", "agency.txt": "agency_id\nA\n"}.items():
            z.writestr(member, body)


def test_feed_bundles(spark, tmp_path):
    bundle(tmp_path, "a.zip", "stop_id,stop_name\n1,Main\n2,\n")
    bundle(tmp_path, "b.zip", "﻿stop_id,stop_name\n9,\"Two, lines\"\n")
    bundle(tmp_path, "c.zip", "stop_id,stop_name\n1,Main\n2,\n")
    (tmp_path / "broken.zip").write_bytes(b"no zip")
    found = readers.read_feed_bundles(spark, f"{tmp_path}/*.zip", {"stops": ["stop_id", "stop_name", "stop_lat"], "feed_info": ["feed_version"]})
    stops = found["stops"].collect()
    assert sorted((r.stop_id, r.stop_name, r.stop_lat) for r in stops) == [("1", "Main", None)] * 2 + [("2", None, None)] * 2 + [("9", "Two, lines", None)]
    assert len({r.feed_hash for r in stops}) == 2  # a and c hold the same members
    all_rows = readers.read_bundles(spark, f"{tmp_path}/*.zip")
    assert [r.path.rsplit("/", 1)[1] for r in readers.broken_bundles(spark, f"{tmp_path}/*.zip").collect()] == ["broken.zip"]
    meta = readers.feed_metadata(all_rows, "America/New_York")
    assert meta.count() == 2
    assert readers.new_bundles(meta, meta.limit(1)).count() == 1


def test_large_and_odd_members(spark, tmp_path):
    n = 120_000
    body = "stop_name,stop_id,,stop_id\r\n" + "".join(f'"Stop ""{i}"", north",x,y,{i}\r\n' for i in range(n)) + '"two\nlines",x,y,last\r\n\r\nshort\r\n,,,\r\n'
    bundle(tmp_path, "a.zip", body)
    bundle(tmp_path, "b.zip", "stop_id\n")
    bundle(tmp_path, "c.zip", "stop_id,stop_lat,more\n7, 1.5 ,\\,8,9\n")
    raw = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "cut.zip").write_bytes(raw[: len(raw) // 2])
    at = raw.index(b"stops.txt") + 5000
    (tmp_path / "sum.zip").write_bytes(raw[:at] + bytes([raw[at] ^ 255]) + raw[at + 1 :])
    rows = readers.read_bundles(spark, f"{tmp_path}/*.zip")
    stops = readers.bundle_tables(rows, {"stops": ["stop_id", "stop_name", "stop_lat"], "shapes": ["shape_id"]}, f"{tmp_path}/parsed")
    got = {(r.stop_id, r.stop_name, r.stop_lat) for r in stops["stops"].collect()}
    assert {(str(i), f'Stop "{i}", north', None) for i in range(n)} < got and len(got) == n + 4
    assert got >= {("last", "two\nlines", None), (None, "short", None), (None, None, None), ("7", None, " 1.5 ")}
    assert stops["shapes"].count() == 0 and stops["shapes"].columns == ["feed_hash", "shape_id"]
    assert sorted(r.path.rsplit("/", 1)[1] for r in readers.broken_bundles(spark, f"{tmp_path}/*.zip").collect()) == ["cut.zip", "sum.zip"]
    assert readers.feed_metadata(rows, "UTC").count() == 3
    assert max(len(r.records) for r in rows.select("records").collect()) == readers.RECORDS


def test_a_large_member_makes_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "GROUP", 4)
    lines = "".join(f"{i},{hash(i * 7919) % 999983},{(i * 31337) % 1000003}\n" for i in range(200_000))
    bundle(tmp_path, "a.zip", "stop_id,stop_name,stop_lat\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 17))
    try:
        stops = readers.read_feed_bundles(spark, f"{tmp_path}/a.zip", {"stops": ["stop_id"]}, f"{tmp_path}/parsed")["stops"]
        used = stops.select("stop_id", F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(used) >= 4 and sum(r["count"] for r in used) == 200_000 and max(r["count"] for r in used) < 150_000


def test_seed_and_table(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("mezzanine_id,station_code\n1,A01\n")
    seed = readers.read_seed(spark, f"{tmp_path}/seed.csv", "mezzanine_id int, station_code string")
    assert seed.first() == (1, "A01")
    seed.createOrReplaceTempView("seed")
    assert readers.read_table(spark, "seed", ["station_code"], 1).collect() == [("A01",)]


def test_window_bounds(spark):
    df = spark.createDataFrame([("2024-07-01 03:59:59",), ("2024-07-01 04:00:00",), ("2024-07-02 04:00:00",)], "t string").select(F.col("t").cast("timestamp"))
    assert readers.read_window(df, ["t"], "t", "2024-07-01", "2024-07-02", tz="America/New_York").count() == 1
    assert readers.read_window(df, ["t"], "t", "2024-07-01", "2024-07-02").count() == 2


def test_replace_windows(spark, tmp_path):
    target = f"{tmp_path}/t"
    rows = [(i, f"2024-01-0{1 + i // 2} 0{i}:00:00", "a" if i < 3 else "b") for i in range(6)]
    df = spark.createDataFrame(rows, "id long, at string, k string").withColumn("at", F.col("at").cast("timestamp"))
    ids = lambda: sorted(r.id for r in spark.read.parquet(target).collect())
    assert writers.write(df, target) == writers.WriteReport(6, 0, "full")
    new = df.where("id = 0").withColumn("id", F.lit(10).cast("long"))
    assert writers.write(new, target, strategy="date_equals", col="at", value="2024-01-01").replaced == 2
    assert ids() == [2, 3, 4, 5, 10]
    r = writers.write(new.drop("k"), target, strategy="time_between", col="at", start="2024-01-02 02:00:00", end="2024-01-02 03:00:00")
    assert (r.rows, r.replaced) == (1, 1) and ids() == [3, 4, 5, 10, 10]
    assert writers.write(new, target, strategy="identity_equals", col="k", value="b").replaced == 3
    with pytest.raises(ValueError):
        writers.write(new.withColumn("more", F.lit(1)), target, strategy="full")
    with pytest.raises(ValueError):
        writers.write(new, target, strategy="other")
    assert writers.append(new, target).rows == 1
    assert writers.compact(spark, target) > 1 and writers.compact(spark, target) == 0
    n = len(ids())
    assert n == 4
    writers.truncate(spark, target)
    assert ids() == [] and spark.read.parquet(target).columns == ["id", "at", "k"]


def test_types_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-03-05 07:00:00")], "id long, at string").withColumn("at", F.col("at").cast("timestamp")).withColumn("none", F.lit(None))
    out = writers.normalise_types(df)
    assert out.schema["none"].dataType == StringType() and all(f.nullable for f in out.schema)
    assert {f.dataType for f in writers.normalise_types(df, True).schema} == {StringType()}
    writers.create_partitioned(out, f"{tmp_path}/p", "at", "day")
    assert spark.read.parquet(f"{tmp_path}/p").first().at_day == date(2024, 3, 5)
    assert writers.partition_column("at", "weird") [0] == "at"
    writers.write_partition(df.select("id"), f"{tmp_path}/q", "k", "x")
    writers.write_partition(df.select("id"), f"{tmp_path}/q", "k", "y")
    writers.write_partition(df.select("id"), f"{tmp_path}/q", "k", "x")
    assert spark.read.parquet(f"{tmp_path}/q").count() == 2
    schema = StructType([StructField("id", LongType()), StructField("gone", StringType())])
    assert writers.check_schema(df.select("id"), schema).first() == (1, None)


@pytest.fixture
def by_day(spark, tmp_path):
    rows = [(i, f"2024-01-0{1 + i // 4} 0{i % 4}:00:00") for i in range(12)]
    df = spark.createDataFrame(rows, "id long, at string").withColumn("at", F.col("at").cast("timestamp"))
    writers.create_partitioned(df, f"{tmp_path}/t", "at", "day")
    return df, f"{tmp_path}/t"


def test_partitions_stay(spark, by_day):
    df, target = by_day
    table = lambda: sorted((r.id, str(r.at_day)) for r in spark.read.parquet(target).collect())
    days = [(i, f"2024-01-0{1 + i // 4}") for i in range(12)]
    before = {x[2] for x in writers.data_files(spark, target)}
    new = df.where("id in (4, 5)").withColumn("id", F.col("id") + 100)
    r = writers.write(new, target, strategy="time_between", col="at", start="2024-01-02 00:00:00", end="2024-01-02 02:00:00")
    assert (r.rows, r.replaced) == (2, 2)
    assert table() == sorted([(i, d) for i, d in days if i not in (4, 5)] + [(104, "2024-01-02"), (105, "2024-01-02")])
    after = {x[2] for x in writers.data_files(spark, target)}
    assert all("at_day=2024-01-02" in x for x in before ^ after) and writers.partition_columns(spark, target) == ["at_day"]
    assert writers.append(df.where("id = 0"), target).rows == 1 and writers.partition_columns(spark, target) == ["at_day"]
    with pytest.raises(ValueError):
        writers.append(df.withColumn("more", F.lit(1)), target)
    rows = table()
    assert writers.compact(spark, target) >= 2 and table() == rows and writers.compact(spark, target) == 0
    writers.truncate(spark, target)
    assert table() == [] and set(spark.read.parquet(target).columns) == {"id", "at", "at_day"}
    assert writers.write(df, target, strategy="full").rows == 12 and len(table()) == 12


def test_rows_of_other_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, k string")
    with pytest.raises(ValueError):
        writers.write_partition(df, f"{tmp_path}/q", "k", "x")


def test_a_crash_is_completed(spark, by_day, monkeypatch):
    df, target = by_day
    plain = writers.finish
    monkeypatch.setattr(writers, "finish", lambda spark, target: None)
    writers.write(df.where("id = 4").withColumn("id", F.lit(50).cast("long")), target, strategy="date_equals", col="at", value="2024-01-02")
    assert spark.read.parquet(target).count() == 12  # the journal is there, nothing has moved
    monkeypatch.setattr(writers, "finish", plain)
    writers.append(df.where("id = 0"), target)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [0, 0, 1, 2, 3, 8, 9, 10, 11, 50]


def test_batches_of_one_window(spark, tmp_path):
    target = f"{tmp_path}/s"
    df = lambda *rows: spark.createDataFrame(list(rows), "n long, w string")
    ids = lambda: sorted((r.w, r.n) for r in spark.read.parquet(target).collect())
    writers.stream_replace(df((1, "a"), (1, "a"), (2, "b")), 0, target, "w", "a")
    writers.stream_replace(df((3, "a")), 1, target, "w", "a")
    writers.stream_replace(df((3, "a")), 1, target, "w", "a")
    assert ids() == [("a", 1), ("a", 1), ("a", 3), ("b", 2)]
    writers.stream_replace(df((7, "a")), 0, target, "w", "a.b")
    assert ids() == [("a", 7), ("b", 2)]
    writers.stream_replace(df((8, "a"), (8, "c")), 1, target, "w", "a")  # the first batch of this load in a window that another load holds
    assert ids() == [("a", 8), ("b", 2), ("c", 8)]


def test_a_stream_keeps_the_tables_types(spark, tmp_path):
    target = f"{tmp_path}/s"
    writers.stream_replace(spark.createDataFrame([(1, "a")], "n long, w string"), 0, target, "w", "x")
    writers.stream_replace(spark.createDataFrame([("2", "a")], "n string, w string"), 1, target, "w", "x")
    for bad in (spark.createDataFrame([("two", "a")], "n string, w string"), spark.createDataFrame([(1, "a", 1)], "n long, w string, more int")):
        with pytest.raises(Exception):  # noqa: B017
            writers.stream_replace(bad, 2, target, "w", "x")
    assert sorted(r.n for r in spark.read.parquet(target).collect()) == [1, 2] and spark.read.parquet(target).schema["n"].dataType == LongType()


def test_partition_columns_of_any_name(spark, tmp_path):
    target = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "f0"), (2, "f1"), (3, "f1"), (4, "f 2/é")], "id long, _feed_hash string")
    writers.create_partitioned(df, target, "_feed_hash")
    assert writers.partition_columns(spark, target) == ["_feed_hash"]
    new = df.where("id = 2").withColumn("id", F.lit(20).cast("long"))
    r = writers.write(new, target, strategy="identity_equals", col="_feed_hash", value="f1")
    rows = lambda: sorted((r.id, r._feed_hash) for r in writers.stored(spark, target).collect())
    assert (r.rows, r.replaced) == (1, 2) and rows() == [(1, "f0"), (4, "f 2/é"), (20, "f1")]
    assert writers.write(new.limit(0), target, strategy="identity_equals", col="_feed_hash", value="f 2/é").replaced == 1
    writers.append(df.where("id = 3"), target)
    assert rows() == [(1, "f0"), (3, "f1"), (20, "f1")] and len(writers.data_files(spark, target)) == 3
    writers.truncate(spark, target)
    assert rows() == [] and writers.partition_columns(spark, target) == ["_feed_hash"]


def test_a_window_for_which_nothing_comes_is_left_empty(spark, by_day, tmp_path):
    df, target = by_day
    ids = lambda t: sorted(r.id for r in writers.stored(spark, t).collect())
    assert writers.write(df.limit(0), target, strategy="date_equals", col="at", value="2024-01-02").replaced == 4
    assert ids(target) == [0, 1, 2, 3, 8, 9, 10, 11]
    assert writers.write(df.limit(0), target, strategy="full").replaced == 8
    assert ids(target) == [] and writers.partition_columns(spark, target) == ["at_day"]
    assert writers.append(df, target).rows == 12
    plain = f"{tmp_path}/plain"
    writers.write(df.limit(0), plain)
    assert ids(plain) == [] and writers.write(df, plain).rows == 12
    part = f"{tmp_path}/part"
    for k in ("x", "y"):
        writers.write_partition(df.select("id"), part, "k", k)
    assert writers.write_partition(df.select("id").limit(0), part, "k", "x").replaced == 12
    assert {r.k for r in writers.stored(spark, part).collect()} == {"y"}
    with pytest.raises(ValueError):
        writers.write_partition(df.selectExpr("id", "'z' k"), part, "k", "y")
    with pytest.raises(ValueError):
        writers.write_partition(df.selectExpr("id", "1 more"), part, "k", "y")
    assert writers.stored(spark, part).count() == 12


def test_only_the_folders_of_a_window_are_listed(spark, tmp_path, monkeypatch):
    target, listed, plain = f"{tmp_path}/many", [], writers._children
    days = spark.range(400).selectExpr("id", "date_add(date'2023-01-01', cast(id as int)) d", "cast(id % 3 as string) k")
    days.repartition(4, "d").write.partitionBy("d", "k").parquet(target)
    monkeypatch.setattr(writers, "_children", lambda s, folder: (listed.append(folder), plain(s, folder))[1])
    new = days.where("id = 40").withColumn("id", F.lit(4000).cast("long"))
    assert writers.write(new, target, strategy="date_equals", col="d", value="2023-02-10").replaced == 1
    assert writers.write(days.limit(0), target, strategy="time_between", col="d", start="2023-03-01", end="2023-03-03").replaced == 2
    # the table's names are read a page at a time, for one file that has its columns; else only what the window names
    assert len({x for x in listed if "/d=" in x and ".new" not in x and not any(w in x for w in ("02-10", "03-01", "03-02"))}) <= 2
    got = {r.id for r in writers.stored(spark, target).collect()}
    assert got == {*range(400), 4000} - {40, 59, 60}
    assert writers.window_folders(spark, target, ["d", "k"], {"d": "date"}, "identity_equals", "k", "1")[0].endswith("k=1")
    hours = writers._values("at_hour", "time_between", "at", None, "2024-01-01 05:30:00", "2024-01-01 07:00:00")[0]
    assert hours == ["2024-01-01-05", "2024-01-01-06", "2024-01-01-07"]
    assert writers._values("at_month", "time_between", "at", None, date(2023, 12, 31), date(2024, 2, 1))[0] == ["2023-12", "2024-01", "2024-02"]
    assert writers._values("at_hour", "time_between", "at", None, "2000-01-01", "2024-01-01") == (None, ("2000-01-01-00", "2024-01-01-00"))


def test_a_refused_move_loses_nothing(spark, by_day, monkeypatch):
    df, target = by_day
    plain, calls = writers._move, []

    def refuse(spark, source, goal):
        calls.append(source)
        if len(calls) == n:
            raise OSError("refused")
        plain(spark, source, goal)

    new = df.where("id in (0, 4)").withColumn("id", F.col("id") + 100)
    for n in (2, 3, 4):  # after the journal: what goes, then what comes
        calls.clear()
        monkeypatch.setattr(writers, "_move", refuse)
        with pytest.raises(OSError):
            writers.write(new, target, strategy="time_between", col="at", start="2024-01-01", end="2024-01-03")
        monkeypatch.setattr(writers, "_move", plain)
        writers.finish(spark, target)
        assert sorted(r.id for r in writers.stored(spark, target).collect()) == [8, 9, 10, 11, 100, 104]
        writers.write(df, target, strategy="full")


def test_writers_take_turns(spark, by_day, monkeypatch):
    df, target = by_day
    plain = writers._commit

    def late(spark, target, made, stale, prefix=""):
        monkeypatch.setattr(writers, "_commit", plain)
        writers.write(df.limit(0), target, strategy="date_equals", col="at", value="2024-01-02")  # another writer comes first
        plain(spark, target, made, stale, prefix)

    monkeypatch.setattr(writers, "_commit", late)
    with pytest.raises(RuntimeError):
        writers.write(df.where("id = 4"), target, strategy="date_equals", col="at", value="2024-01-02")
    assert writers.stored(spark, target).count() == 8


def test_compaction_packs_without_a_shuffle(spark, tmp_path):
    target = f"{tmp_path}/c"
    df = spark.range(0, 60_000, 1, 1).selectExpr("id", "cast(id % 2 as string) k", "sha2(cast(id as string), 256) t")
    for i in range(12):
        writers.append(df.where(F.col("id").between(i * 5000, i * 5000 + 4999)).coalesce(1), target) if i else df.where("id < 5000").coalesce(1).write.partitionBy("k").parquet(target)
    sizes = [x[3] for x in writers.data_files(spark, target)]
    aim = 3 * max(sizes) + 1000
    assert writers.compact(spark, target, aim) == 24
    files = writers.data_files(spark, target)
    assert 6 <= len(files) <= 12 and all(x[3] <= 2 * aim for x in files) and {x[0] for x in files} == {"k=0", "k=1"}
    for _, _, path, _ in files:
        ids = [r.id for r in spark.read.parquet(path).collect()]
        assert all(b - a == 2 for a, b in zip(ids, ids[1:], strict=False) if a // 5000 == b // 5000)  # a file's rows stay in order
    assert sorted(r.id for r in spark.read.parquet(target).select("id").collect()) == list(range(60_000))


def test_an_emptied_day_is_emptied(spark, tmp_path):
    target = f"{tmp_path}/inc"
    facts = spark.createDataFrame([(date(2024, 1, 1 + i % 3), i) for i in range(9)], "service_date date, n long")
    build = lambda facts: facts.groupBy("service_date").agg(F.sum("n").alias("n"))
    for df, days in ((facts, {1, 2, 3}), (facts.where("day(service_date) <> 2"), {1, 3})):
        for per_day in (False, True):
            incremental.incremental_overwrite(build, {"facts": (df, True)}, target, "service_date", date(2024, 1, 1), date(2024, 1, 4), lookback_days=0, per_day=per_day)
            assert {r.service_date.day for r in spark.read.parquet(target).collect()} == days


def test_incremental_is_repeatable(spark, tmp_path):
    target = f"{tmp_path}/inc"
    rows = [(date(2024, 1, 1 + i % 9), i) for i in range(90)]
    facts = spark.createDataFrame(rows, "service_date date, n long")
    names = spark.createDataFrame([(date(2020, 1, 1), "x")], "service_date date, name string")
    build = lambda facts, names: facts.crossJoin(names.select("name")).groupBy("service_date").agg(F.sum("n").alias("n"))
    inputs = {"facts": (facts, True), "names": (names, False)}
    spans = incremental.incremental_overwrite(build, inputs, target, "service_date", date(2024, 1, 4), date(2024, 1, 8))
    assert spans == [(date(2024, 1, 1), date(2024, 1, 8))]
    first = sorted(spark.read.parquet(target).collect())
    incremental.incremental_overwrite(build, inputs, target, "service_date", date(2024, 1, 6), date(2024, 1, 8), per_day=True, floor=date(2024, 1, 5))
    assert sorted(spark.read.parquet(target).collect()) == first and len(first) == 7
    assert incremental.rolling_window(date(2024, 1, 9)) == (date(2024, 1, 1), date(2024, 1, 9))
    assert incremental.window_from_key("2024-01-02", date(2024, 1, 3)) == (date(2024, 1, 2), date(2024, 1, 3))
    with pytest.raises(ValueError):
        incremental.window_from_key("2024-01-03", date(2024, 1, 3))
