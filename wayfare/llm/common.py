"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: A-Z to a-z on UTF-8 bytes; every other byte stays.
LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Spark's setting by which a query's shuffle files go when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Spark's setting of the rows that go to Python at a time, and how many of whole texts or sets should.
BATCH, ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a folder of its own.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wayfare-"))
    return sc.getCheckpointDir().rstrip("/")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is written or collected inside goes to Python ``ROWS`` rows at a time, so that neither side holds many texts or sets.

    Batches that the session has smaller than that stay so.
    """
    before, now = spark.conf.get(BATCH, None), int(spark.conf.get(BATCH))
    spark.conf.set(BATCH, str(min(now, ROWS) if now > 0 else ROWS))
    try:
        yield
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows, at most so many at a time, for work that makes several copies of a batch."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The shuffle files of the write go as soon as it has ended; the folder stays until :func:`drop`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete the folders of stored tables whose last reader has been written or collected."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
