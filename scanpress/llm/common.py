"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanpress.operators.ranking import materialize
from scanpress.session import ensure_checkpoint_dir, scratch_path, scratch_released, ship_package

__all__ = [
    "broadcast_ids", "file_system", "materialize", "prepared", "qualified_uri", "scratch_released", "scratch_uri", "shuffles_released",
    "small_batches", "table",
]

BATCH_BYTES, READ_ROWS = 1 << 20, 512
BROADCAST_ROWS = 1_000_000  # rows of at most three numbers that may be broadcast


def prepared(spark: SparkSession) -> SparkSession:
    """Shared folder known and package on the executors' path."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Jobs started inside send rows to Python in batches of about ``size`` bytes at most, and read ``READ_ROWS`` rows at a time.

    Spark's own bounds are 10,000 rows or 64 MB, held by the executor and by its Python worker for every core, and 4096
    rows of Parquet, which for texts and sets are arrays of 8 MB and more.
    """
    with (
        _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size)),
        _setting(spark, "spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS)),
    ):
        yield


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries run inside delete their shuffle files as they end.

    Else those files stay until the driver happens to collect the frames, which many steps in a row do not wait for.
    """
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def broadcast_ids(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of ids, broadcast if it has at most ``most`` rows, else joined by shuffling.

    Without the hint both sides are shuffled before Spark knows how small the table is, texts included.
    """
    return F.broadcast(df) if df.count() <= most else df


def qualified_uri(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the cluster's default file system, in the form Arrow file systems take."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - Hadoop FS has no Python API
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    uri = fs.makeQualified(hpath).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder of ``spark.checkpoint.dir``, for files that tasks write."""
    return qualified_uri(spark, scratch_path(spark, name))


def file_system(uri: str):
    """(file system, path) of a qualified folder, used inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)
