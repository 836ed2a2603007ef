"""Scans: windows, keys, seeds, spines and schedule bundles."""

from __future__ import annotations

import csv
import hashlib
import io
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wayfare.sources.writers import scratch

#: The schedule tables that a bundle may hold; fixed values.
FEED_TABLES = ("agency", "calendar", "calendar_dates", "feed_info", "routes", "shapes", "stop_times", "stops", "timepoints", "timepoint_times", "trips")


def read_window(df: DataFrame, cols: list[str], date_col: str, start: str, end: str, row_limit: int | None = None, tz: str | None = None) -> DataFrame:
    """Rows of [start, end); with ``tz`` the bounds are local times of a column kept in UTC."""
    low, high = (F.lit(x).cast("timestamp") for x in (start, end))
    if tz:
        low, high = F.to_utc_timestamp(low, tz), F.to_utc_timestamp(high, tz)
    out = df.where((F.col(date_col) >= low) & (F.col(date_col) < high)).select(*cols)
    return out.limit(row_limit) if row_limit else out


def read_by_date_key(fact: DataFrame, cal: DataFrame, key: str, cal_key: str, cal_date: str, start: str, end: str) -> DataFrame:
    """Facts keyed by a calendar's surrogate, with ``service_date``, for a closed range of days."""
    days = cal.where(F.col(cal_date).between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(F.col(cal_key).alias("_k"), F.col(cal_date).alias("service_date"))
    return fact.join(days, fact[key] == F.col("_k")).drop("_k")


def read_equals(df: DataFrame, cols: list[str], col: str, value: object) -> DataFrame:
    return df.where(F.col(col) == value).select(*cols)


def read_seed(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """A table of the catalog, or a Parquet path."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    df = df.select(*columns) if columns else df
    return df.limit(limit) if limit else df


def inline(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def date_spine(spark: SparkSession, start: str, end_exclusive: str, unit: str = "day") -> DataFrame:
    a, b = F.lit(start).cast("date"), F.lit(end_exclusive).cast("date")
    return spark.range(1).select(F.explode(F.sequence(a, b, F.expr(f"interval 1 {unit}"))).alias("date")).where(F.col("date") < b)


def read_bundles(spark: SparkSession, glob: str) -> DataFrame:
    """The records of all bundles in files, as :func:`parse_bundles` gives them; broken files are named by :func:`broken_bundles`."""
    return parse_bundles(spark.read.format("binaryFile").load(glob).select("path", F.col("modificationTime").alias("retrieved"), "content"))


#: Errors of a file that is no archive, or of which a member is cut off or does not have its checksum.
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError)
#: Bytes read at a time, and records of a block.
BLOCK, RECORDS = 1 << 20, 5000
PARSED = "feed_hash string, path string, retrieved timestamp, table string, header string, records array<string>"


def bundle_hash(bundle: zipfile.ZipFile) -> str:
    """Over member names and contents in name order, so a bundle zipped anew is the same feed; reads every member to its end."""
    digest = hashlib.md5()
    for name in sorted(n for n in bundle.namelist() if not n.endswith("/")):
        digest.update(name.encode() + b"\0")
        with bundle.open(name) as f:
            while block := f.read(BLOCK):
                digest.update(block)
        digest.update(b"\0")
    return digest.hexdigest()


def records(lines: Iterable[str]) -> Iterator[str]:
    """CSV records: lines, or several where a quoted value goes on; empty ones are left out."""
    held, quotes = [], 0
    for line in lines:
        held.append(line)
        quotes += line.count('"')
        if quotes % 2 == 0:
            record = "".join(held).rstrip("\r\n")
            held, quotes = [], 0
            if record:
                yield record
    if held:
        yield "".join(held).rstrip("\r\n")


def parse_bundles(files: DataFrame) -> DataFrame:
    """Blocks of the CSV records of each known member of each bundle (path, retrieved, content), with the member's header.

    An archive's members are inflated a block at a time, never one whole; the first reading gives
    the feed's hash (see :func:`bundle_hash`) and finds broken ones, which give no rows.  The records are
    parsed by Spark (:func:`bundle_tables`), so a large member becomes many tasks.  A member without records
    gives one block without any.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, at, content in zip(*(b.column(i) for i in range(3)), strict=True):
                try:
                    bundle = zipfile.ZipFile(io.BytesIO(content.as_buffer()))
                    feed = bundle_hash(bundle)
                except BROKEN:
                    continue
                for name in sorted(bundle.namelist()):
                    known = name.rsplit("/", 1)[-1].removesuffix(".txt")
                    if known not in FEED_TABLES or name.endswith("/"):
                        continue
                    with io.TextIOWrapper(bundle.open(name), "utf-8-sig", errors="replace", newline="") as lines:
                        found = records(lines)
                        header = next(found, None)
                        part = list(islice(found, RECORDS))
                        while header is not None:
                            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((feed, pa.string()), (path.as_py(), pa.string()), (at.as_py(), b.schema.field(1).type), (known, pa.string()), (header, pa.string()), (part, pa.list_(pa.string())))], names)
                            part = list(islice(found, RECORDS))
                            if not part:
                                break

    names = ["feed_hash", "path", "retrieved", "table", "header", "records"]
    return files.select("path", "retrieved", "content").mapInArrow(run, PARSED)


def broken_bundles(spark: SparkSession, glob: str) -> DataFrame:
    """(path, error) of the files that are no ZIP archives, or of which a member cannot be read to its end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                try:
                    bundle_hash(zipfile.ZipFile(io.BytesIO(content.as_buffer())))
                except BROKEN as e:
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([str(e)])], ["path", "error"])

    return spark.read.format("binaryFile").load(glob).select("path", "content").mapInArrow(run, "path string, error string")


def header_columns(header: str) -> list[str | None]:
    """The names in a header; of equal ones the last counts, and one without a name is no column."""
    names = [n.strip() for n in next(csv.reader([header], strict=False), [])]
    return [n if n and n not in names[i + 1 :] else None for i, n in enumerate(names)]


#: Blocks of a row group: as many row groups as tasks can read a large member.
GROUP = 16


def bundle_tables(rows: DataFrame, columns: dict[str, list[str]], folder: str | None = None) -> dict[str, DataFrame]:
    """One all-text table per member named in ``columns``, with its feed's hash; empty values are NULL.

    Bundles are read once, to ``folder`` (partitioned by table, in row groups that are read by themselves).
    Each table is parsed by Spark's CSV functions, once for each header that its members have; producers
    give their members one of few headers.
    """
    spark = rows.sparkSession
    folder = folder or scratch(spark)
    rows.write.partitionBy("table").option("parquet.block.row.count.limit", GROUP).option("compression", "zstd").parquet(folder)
    parsed = spark.read.schema(rows.schema).parquet(folder)
    headers = [(r.table, r.header) for r in parsed.select("table", "header").distinct().orderBy("table", "header").collect()]
    out = {}
    for t, cols in columns.items():
        parts = []
        for header in [h for name, h in headers if name == t] or [""]:
            there = header_columns(header)
            schema = StructType([StructField(f"_c{i}", StringType()) for i in range(max(len(there), 1))])
            value = F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"escape": '"', "mode": "PERMISSIVE"})
            mine = parsed.where((F.col("table") == t) & (F.col("header") == header)).select("feed_hash", F.explode("records").alias("record")).withColumn("v", value)
            parts.append(mine.select("feed_hash", *((F.nullif(F.col(f"v._c{there.index(c)}"), F.lit("")) if c in there else F.lit(None).cast("string")).alias(c) for c in cols)))
        out[t] = reduce(DataFrame.unionAll, parts)
    return out


def read_feed_bundles(spark: SparkSession, glob: str, columns: dict[str, list[str]], folder: str | None = None) -> dict[str, DataFrame]:
    return bundle_tables(read_bundles(spark, glob), columns, folder)


def new_bundles(bundles: DataFrame, known: DataFrame) -> DataFrame:
    return bundles.join(known.select("feed_hash"), "feed_hash", "left_anti")


def feed_metadata(bundles: DataFrame, tz: str) -> DataFrame:
    """A row per feed: source and local retrieval time."""
    return bundles.groupBy("feed_hash").agg(F.min(F.struct("retrieved", "path")).alias("first")).select("feed_hash", F.col("first.path").alias("source"), F.from_utc_timestamp("first.retrieved", tz).alias("date_retrieved"))
