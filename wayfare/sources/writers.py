"""Sinks on Parquet tables: append, replacement by value, day or window, compaction.

A replacement first turns its window into the partition folders that can hold it; only these are
listed and read, and of their files only those with rows of the window are rewritten.  A window
for which nothing comes is left empty.  New files are made beside the table; a journal then
names what comes and what goes.  What goes is moved to a folder that readers do not see, then the new
files are moved in.  A job that fails before the journal leaves the table as it was; what a crash
or a refused move cuts off later is completed by the next write (or :func:`finish`).

Writers of one table take turns: a writer that finds another's journal, or files gone that it was
to replace, stops before it changes anything.  A reader during the move may miss rows of the window.
"""

from __future__ import annotations

import hashlib
import json
import logging
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StringType, StructField, StructType

log = logging.getLogger(__name__)
TRANSFORMS = ("identity", "hour", "day", "month", "year")
SHAPES = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
STRATEGIES = ("identity_equals", "date_equals", "time_between", "full")


@dataclass(frozen=True)
class WriteReport:
    rows: int
    replaced: int
    strategy: str
    start: object = None
    end: object = None
    key: object = None


def window_condition(strategy: str, col: str | None, value: object = None, start: object = None, end: object = None) -> Column:
    """The rows of the target that a strategy replaces."""
    if strategy == "full":
        return F.lit(True)
    if strategy == "identity_equals":
        return F.col(col).eqNullSafe(F.lit(value))
    if strategy == "date_equals":
        day = F.lit(value).cast("date")
        return (F.col(col) >= day.cast("timestamp")) & (F.col(col) < F.date_add(day, 1).cast("timestamp"))
    if strategy == "time_between":
        return (F.col(col) >= F.lit(start).cast("timestamp")) & (F.col(col) < F.lit(end).cast("timestamp"))
    raise ValueError(f"unknown strategy {strategy!r}; one of {STRATEGIES}")


def _path(spark: SparkSession, target: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, target: str) -> bool:
    path, fs = _path(spark, target)
    return fs.exists(path)


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below ``spark.checkpoint.dir``; a local session may go without the setting."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return f"{(base or tempfile.mkdtemp(prefix='wayfare-')).rstrip('/')}/{uuid.uuid4().hex}"


def _children(spark: SparkSession, folder: str) -> Iterator:
    """What a folder holds, as readers see it, page by page; a ``_`` or ``.`` hides names, but no ``_column=value``."""
    path, fs = _path(spark, folder)
    found = fs.listStatusIterator(path)
    while found.hasNext():
        status = found.next()
        name = status.getPath().getName()
        if not name.startswith(".") and ("=" in name or not name.startswith("_")):
            yield status


def _below(spark: SparkSession, folder: str) -> Iterator:
    for status in _children(spark, folder):
        if status.isDirectory():
            yield from _below(spark, status.getPath().toString())
        else:
            yield status


def data_files(spark: SparkSession, target: str, folders: list[str] | None = None) -> list[tuple[str, str, str, int]]:
    """(folder below the table, name, path, bytes) of a table's files, or of those in some of its folders."""
    root, fs = _path(spark, target)
    top = fs.getFileStatus(root).getPath().toString().rstrip("/") + "/"
    out = []
    for folder in [target] if folders is None else [f for f in folders if exists(spark, f)]:
        for status in _below(spark, folder):
            path = status.getPath().toString()
            below, _, name = path.removeprefix(top).rpartition("/")
            out.append((below, name, path, status.getLen()))
    return out


def _some_file(spark: SparkSession, target: str, but: tuple[str, ...] = ()) -> tuple[list[str], str] | None:
    """(folders below the table, path) of one of its files, without listing the others; none below ``but``."""
    root, fs = _path(spark, target)
    top = fs.getFileStatus(root).getPath().toString().rstrip("/") + "/"
    hidden = {x.rstrip("/") for x in but}

    def first(folder: str) -> str | None:
        for status in _children(spark, folder):
            path = status.getPath().toString()
            if path not in hidden and (found := first(path) if status.isDirectory() else path):
                return found
        return None

    path = first(target)
    return (path.removeprefix(top).split("/")[:-1], path) if path else None


def partition_columns(spark: SparkSession, target: str) -> list[str]:
    """The columns that a table's folders are named by."""
    found = _some_file(spark, target)
    return [x.partition("=")[0] for x in found[0] if "=" in x] if found else []


def stored(spark: SparkSession, target: str, paths: list[str] | None = None) -> DataFrame:
    """A table, or some of its files or folders; partition columns are texts, as the folders have them."""
    found = _some_file(spark, target)
    if not found:
        raise ValueError(f"no table in {target}")
    parts = [x.partition("=")[0] for x in found[0] if "=" in x]
    own = [f for f in spark.read.parquet(found[1]).schema if f.name not in parts]
    schema = StructType([*own, *(StructField(p, StringType()) for p in parts)])
    return spark.read.schema(schema).option("basePath", target).parquet(*([target] if paths is None else paths))


JOURNAL, BATCH = "_replacing", "_batch"


def _note(spark: SparkSession, path: str, what: object) -> None:
    at, fs = _path(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(json.dumps(what).encode()))
    out.close()


def _noted(spark: SparkSession, path: str) -> object:
    """What a small file says, None without one."""
    at, fs = _path(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def _move(spark: SparkSession, source: str, goal: str) -> None:
    """A refused move is an error; one that was made before is not made again."""
    (a, fs), (b, _) = _path(spark, source), _path(spark, goal)
    if not fs.exists(a) and fs.exists(b):
        return
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"could not move {source} to {goal}")


def _move_in(spark: SparkSession, source: str, goal: str, prefix: str) -> None:
    """What ``source`` holds goes to ``goal``: whole folders where there is none of that name, else file by file."""
    for status in list(_children(spark, source)):
        name = status.getPath().getName()
        if status.isDirectory() and (prefix or exists(spark, f"{goal}/{name}")):
            _move_in(spark, f"{source}/{name}", f"{goal}/{name}", prefix)
        else:
            _move(spark, f"{source}/{name}", f"{goal}/{name if status.isDirectory() else prefix + name}")


def _commit(spark: SparkSession, target: str, made: str, stale: list[str], prefix: str = "", batch: tuple[str, int] | None = None) -> None:
    """Moves the files of ``made`` into the table, with ``prefix`` before their names, and removes ``stale`` (files or folders).

    ``batch`` is the load's last batch from then on.
    """
    root, fs = _path(spark, target)
    fs.mkdirs(root)
    top = fs.getFileStatus(root).getPath().toString().rstrip("/") + "/"
    journal = _path(spark, f"{target}/{JOURNAL}")[0]
    if gone := [x for x in stale if not exists(spark, x)]:
        raise RuntimeError(f"the table changed while its replacement was made: {gone[:3]}")
    if fs.exists(journal):
        raise RuntimeError(f"another writer replaces rows of {target}")
    plan = {"made": made, "stale": [x.removeprefix(top) for x in stale], "prefix": prefix, "old": f"_old.{uuid.uuid4().hex}", "batch": batch}
    draft = f"{target}/{JOURNAL}.{uuid.uuid4().hex}"
    _note(spark, draft, plan)
    _move(spark, draft, journal.toString())
    finish(spark, target)


def finish(spark: SparkSession, target: str) -> None:
    """Completes the replacement that the table's journal names, if any; doing it again changes nothing."""
    journal, fs = _path(spark, f"{target}/{JOURNAL}")
    if not fs.exists(journal):
        return
    plan = _noted(spark, f"{target}/{JOURNAL}")
    old = f"{target}/{plan['old']}"
    for below in plan["stale"]:
        # what stands there after it was moved away is new
        if not exists(spark, f"{old}/{below}"):
            _move(spark, f"{target}/{below}", f"{old}/{below}")
    if exists(spark, plan["made"]):
        _move_in(spark, plan["made"], target, plan["prefix"])
    if plan["batch"]:
        load, n = plan["batch"]
        _note(spark, f"{target}/{BATCH}.{load}", n)
    fs.delete(_path(spark, plan["made"])[0], True)
    fs.delete(journal, False)
    fs.delete(_path(spark, old)[0], True)


def partition_column(col: str, transform: str) -> tuple[str, Column]:
    """Name and expression of a transform's partition column; unknown transforms are taken as identity."""
    if transform in ("identity", "") or transform not in TRANSFORMS:
        return col, F.col(col)
    return f"{col}_{transform}", F.date_format(col, SHAPES[transform])


def check_schema(df: DataFrame, target: StructType) -> DataFrame:
    """``df`` in the target's columns: a new column is an error, a missing one is filled with NULL and logged."""
    have = {f.name for f in target}
    if added := sorted(set(df.columns) - have):
        raise ValueError(f"columns that the target does not have: {added}")
    if missing := sorted(have - set(df.columns)):
        log.warning("columns filled with NULL: %s", missing)
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target))


def normalise_types(df: DataFrame, force_string: bool = False) -> DataFrame:
    """All columns nullable; columns without a type, or all on demand, become text."""
    kind = lambda t: StringType() if force_string or isinstance(t, NullType) else t
    out = df.select(*(F.col(f.name).cast(kind(f.dataType)).alias(f.name) for f in df.schema))
    return out.to(StructType.fromJson({"type": "struct", "fields": [{**f.jsonValue(), "nullable": True} for f in out.schema]}))


def create_partitioned(df: DataFrame, target: str, col: str, transform: str = "identity") -> None:
    name, expr = partition_column(col, transform)
    df.withColumn(name, expr).write.mode("errorifexists").partitionBy(name).parquet(target)


def _fitted(df: DataFrame, target: str) -> tuple[DataFrame, list[str], StructType]:
    """``df`` in the table's columns, the table's partition columns (computed anew where they derive from a column), and its schema."""
    spark = df.sparkSession
    schema, parts = stored(spark, target).schema, partition_columns(spark, target)
    for part in parts:
        col, _, transform = part.rpartition("_")
        if transform in TRANSFORMS[1:] and col in schema.names and col in df.columns:
            df = df.withColumn(part, partition_column(col, transform)[1])
    return check_schema(df, schema), parts, schema


def _put(df: DataFrame, path: str, parts: list[str], mode: str = "errorifexists", more: DataFrame | None = None, foreign: Column | None = None, dealt: bool = False) -> int:
    """Writes ``df`` (and ``more``); the number of rows of ``df``, of which none may be ``foreign``.

    With ``dealt``, rows are brought together by partition first, in tasks of an even size, so that small batches make few files.
    """
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.lit(False) if foreign is None else foreign).alias("foreign"))
    rows = df if more is None else df.unionByName(more)
    w = (rows.hint("rebalance", *map(F.col, parts)) if dealt else rows).write.mode(mode)
    (w.partitionBy(*parts) if parts else w).parquet(path)
    if seen.get["foreign"]:
        raise ValueError(f"{seen.get['foreign']} rows of other partitions")
    return seen.get["n"]


def _empty(spark: SparkSession, made: str, schema: StructType, parts: list[str]) -> None:
    """A file without rows, which keeps the columns of a table that would have no file."""
    folder = "".join(f"/{c}=__HIVE_DEFAULT_PARTITION__" for c in parts)
    spark.createDataFrame([], StructType([f for f in schema if f.name not in parts])).coalesce(1).write.mode("overwrite").parquet(f"{made}{folder}")


def append(df: DataFrame, target: str) -> WriteReport:
    """Adds rows; columns that the table does not have are an error."""
    parts: list[str] = []
    if exists(df.sparkSession, target):
        finish(df.sparkSession, target)
        df, parts, _ = _fitted(df, target)
    return WriteReport(_put(df, target, parts, "append"), 0, "append")


#: A window of more folders than that is found by their names instead.
NAMED = 1000


def _moment(x: object) -> datetime:
    return x if isinstance(x, datetime) else datetime(x.year, x.month, x.day) if isinstance(x, date) else datetime.fromisoformat(str(x))


def _values(part: str, strategy: str, col: str | None, value: object, start: object, end: object) -> tuple[list[str] | None, tuple[str, str] | None]:
    """What a window means for a partition column: its values, if they are few, and the first and last of them as texts."""
    if strategy == "identity_equals" and part == col:
        named = isinstance(value, (str, int)) or type(value) is date
        return [str(value).lower() if isinstance(value, bool) else str(value)] if named and value != "" else None, None
    if strategy not in ("date_equals", "time_between"):
        return None, None
    low = _moment(str(value)[:10] if strategy == "date_equals" else start)
    high = low + timedelta(days=1) if strategy == "date_equals" else _moment(end)
    for t in TRANSFORMS[1:]:
        if part == f"{col}_{t}":
            shape, step = {"hour": "%Y-%m-%d-%H", "day": "%Y-%m-%d", "month": "%Y-%m", "year": "%Y"}[t], timedelta(hours=1) if t == "hour" else timedelta(days=1)
            n = (high - low) // step + 2
            named = sorted({min(low + i * step, high).strftime(shape) for i in range(n)}) if n <= NAMED * (1 if t in ("hour", "day") else 30) else None
            return named, (low.strftime(shape), high.strftime(shape))
    return None, None


def window_folders(spark: SparkSession, target: str, parts: list[str], kinds: dict[str, str], strategy: str, col: str | None, value: object = None, start: object = None, end: object = None) -> list[str]:
    """The partition folders that can hold rows of a window: the table's own if no partition column says more.

    Folders are named, not listed, where the window gives a column's values; else one level's names are read.
    """
    known = [_values(p, strategy, col, value, start, end) for p in parts]
    days = (_moment(start), _moment(end)) if strategy == "time_between" else None
    for i, p in enumerate(parts):
        if p == col and kinds.get(p) == "date" and strategy in ("date_equals", "time_between"):
            low, high = days or (_moment(str(value)[:10]), _moment(str(value)[:10]) + timedelta(days=1))
            span = [str(low.date() + timedelta(days=k)) for k in range((high - low).days + 2)]
            known[i] = ([x for x in span if low <= _moment(x) < high] if len(span) <= NAMED else None), (str(low.date()), str(high.date()))
    depth = max((i + 1 for i, k in enumerate(known) if k != (None, None)), default=0)
    found = [target.rstrip("/")]
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for part, (values, between) in zip(parts[:depth], known, strict=False):
        if values is not None:
            found = [f for f in (f"{x}/{escape(part)}={escape(v)}" for x in found for v in values) if exists(spark, f)]
        else:
            names = ((x, s.getPath().getName()) for x in found for s in _children(spark, x))
            found = [f"{x}/{n}" for x, n in names if between is None or between[0] <= unquote(n.partition("=")[2]) <= between[1]]
    return found


def write(df: DataFrame, target: str, mode: str = "overwrite", strategy: str | None = "full", col: str | None = None, value: object = None, start: object = None, end: object = None, by: list[str] | None = None, only: bool = False) -> WriteReport:
    """Append, or replace the rows of a window: what lies outside it stays, and files without a row of it are not touched.

    A new table is partitioned by the columns ``by``.  With ``only``, rows outside the window are an error.
    """
    if mode == "append":
        return append(df, target)
    spark, strategy = df.sparkSession, strategy or "full"
    inside = F.coalesce(window_condition(strategy, col, value, start, end), F.lit(False))
    foreign = ~inside if only else None
    there = exists(spark, target)
    if there:
        finish(spark, target)
    if not there or not _some_file(spark, target):
        made = f"{target}.{uuid.uuid4().hex}.new"
        rows = _put(df, made, by or [], foreign=foreign)
        if not data_files(spark, made):
            _empty(spark, made, df.schema, by or [])
        _commit(spark, target, made, [])
        return WriteReport(rows, 0, strategy, start, end, value)
    kinds = dict(df.dtypes)
    df, parts, schema = _fitted(df, target)
    folders = window_folders(spark, target, parts, kinds, strategy, col, value, start, end)
    hit = stored(spark, target, folders).where(inside).groupBy(F.col("_metadata.file_path").alias("path")).count().collect() if folders else []
    uri = spark._jvm.java.net.URI
    touched = [spark._jvm.org.apache.hadoop.fs.Path(uri(r.path)).toString() for r in hit]
    stale = [s.getPath().toString() for s in _children(spark, target)] if strategy == "full" else touched
    rest = stored(spark, target, touched).where(~inside) if touched and strategy != "full" else None
    made = f"{target}.{uuid.uuid4().hex}.new"
    rows = _put(df, made, parts, more=rest, foreign=foreign)
    if stale and not data_files(spark, made) and not _some_file(spark, target, tuple(stale)):
        _empty(spark, made, schema, parts)
    _commit(spark, target, made, stale)
    return WriteReport(rows, sum(r["count"] for r in hit), strategy, start, end, value)


def write_partition(df: DataFrame, target: str, col: str, value: object) -> WriteReport:
    """Replaces one partition of a partitioned table and no other, also by nothing; rows of another partition are an error."""
    df = df if col in df.columns else df.withColumn(col, F.lit(value))
    return write(df, target, strategy="identity_equals", col=col, value=value, by=[col], only=True)


def replace_partitions(df: DataFrame, target: str, col: str) -> None:
    """Replaces the partitions that ``df`` has rows of."""
    spark, made = df.sparkSession, f"{target}.{uuid.uuid4().hex}.new"
    if exists(spark, target):
        finish(spark, target)
        df, _, _ = _fitted(df, target)
    df.write.partitionBy(col).parquet(made)
    there = [f"{target}/{s.getPath().getName()}" for s in _children(spark, made) if s.isDirectory()]
    root, fs = _path(spark, target)
    _commit(spark, target, made, [fs.getFileStatus(_path(spark, x)[0]).getPath().toString() for x in there if exists(spark, x)])


def load_name(load: str) -> str:
    return hashlib.md5(load.encode()).hexdigest()[:16]


def upsert(df: DataFrame, target: str, keys: list[str], by: str, load: str, batch_id: int) -> int:
    """Rows of ``df`` take the place of those of equal keys; returns how many came.  The table is partitioned by ``by``, which the keys determine.

    Only the partitions that ``df`` has rows of are read and written.  A load's batches come in
    order, each once: one that was there before, or an older one, changes nothing.
    """
    spark, name = df.sparkSession, load_name(load)
    there = exists(spark, target)
    if there:
        finish(spark, target)
        last = _noted(spark, f"{target}/{BATCH}.{name}")
        if last is not None and last >= batch_id:
            return 0
    df = df.persist()
    try:
        made, stale, rest, parts = f"{target}.{uuid.uuid4().hex}.new", [], None, [by]
        if there and _some_file(spark, target):
            df, parts, _ = _fitted(df, target)
            escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
            values = [r[0] for r in df.select(F.col(by).cast("string")).distinct().collect()]
            names = ["__HIVE_DEFAULT_PARTITION__" if v is None else escape(v) for v in values]
            folders = [f for f in (f"{target}/{by}={n}" for n in names) if exists(spark, f)]
            if folders:
                stale = [path for _, _, path, _ in data_files(spark, target, folders)]
                old, new = stored(spark, target, folders), df.select(*(F.col(k).alias(f"_{k}") for k in keys))
                rest = old.join(new, reduce(Column.__and__, (old[k].eqNullSafe(new[f"_{k}"]) for k in keys)), "left_anti")
        rows = _put(df, made, parts, more=rest, dealt=True)
        _commit(spark, target, made, stale, batch=(name, batch_id))
    finally:
        df.unpersist()
    return rows


def stream_replace(batch: DataFrame, batch_id: int, target: str, window_col: str, load: str) -> None:
    """For ``foreachBatch``: the first batch of a window in a load replaces the window, later ones add to it.

    Files carry their load and batch in their names, so a batch that runs again replaces its own
    rows only.  A later load, by another name, starts its windows anew.  Repeated rows stay.
    Batches come in the table's columns and types: a new column, or a value that its column
    cannot take, is an error before anything changes.
    """
    spark, made = batch.sparkSession, f"{target}.{uuid.uuid4().hex}.new"
    loaded = f"{load_name(load)}."
    own, parts = f"{loaded}{batch_id}.", [window_col]
    if there := exists(spark, target):
        finish(spark, target)
        batch, parts, _ = _fitted(batch, target)
    batch.write.partitionBy(*parts).parquet(made)
    windows = {folder for folder, *_ in data_files(spark, made)} if exists(spark, made) else set()
    files = data_files(spark, target, [f"{target}/{w}" for w in sorted(windows)]) if there else []
    stale = [path for folder, name, path, _ in files if folder in windows and (name.startswith(own) or not name.startswith(loaded))]
    _commit(spark, target, made, stale, own)


#: Folders that one job of a compaction takes.
FOLDERS = 64


def compact(spark: SparkSession, target: str, max_bytes: int = 128 << 20) -> int:
    """Rewrites the small files of each folder that has several as files of about ``max_bytes``; returns how many there were.

    Nothing is shuffled: Spark's scan packs a folder's files into read groups of ``max_bytes``, and each
    group is written as one file, its files' rows in their order.  Large files and the table's
    partitions stay as they are.
    """
    finish(spark, target)
    small: dict[str, list[tuple[str, int]]] = {}
    for folder, _, path, size in data_files(spark, target):
        if size < max_bytes:
            small.setdefault(folder, []).append((path, size))
    several = [v for _, v in sorted(small.items()) if len(v) > 1]
    if not several:
        return 0
    parts, made = partition_columns(spark, target), f"{target}.{uuid.uuid4().hex}.new"
    packing = {"spark.sql.files.maxPartitionBytes": str(max_bytes), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in packing}
    try:
        for k, v in packing.items():
            spark.conf.set(k, v)
        for i in range(0, len(several), FOLDERS):
            rows = [stored(spark, target, [path for path, _ in v]) for v in several[i : i + FOLDERS]]
            _put(reduce(DataFrame.unionAll, rows), made, parts, "append")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    stale = [path for v in several for path, _ in v]
    _commit(spark, target, made, stale)
    return len(stale)


def truncate(spark: SparkSession, target: str) -> None:
    """An empty table of the same columns and partitions."""
    finish(spark, target)
    made = f"{target}.{uuid.uuid4().hex}.new"
    _empty(spark, made, stored(spark, target).schema, partition_columns(spark, target))
    _commit(spark, target, made, [s.getPath().toString() for s in _children(spark, target)])
