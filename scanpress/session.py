"""Session and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every scanpress job expects; the cluster may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Checkpoint files of frames no longer referenced are removed by the cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    app: str = "scanpress",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the scanpress defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster names it; only a local-mode session (tests, bench) without
    one gets a folder of its own.  A cluster session without it is an error:
    a machine-local folder would not survive the loss of an executor.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if conf_dir:
        if current is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if current is not None:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        msg = "set spark.checkpoint.dir to a shared folder for this cluster"
        raise RuntimeError(msg)
    local_dir = os.path.join("/tmp", f"scanpress-checkpoints-{uuid.uuid4().hex[:8]}")
    spark.conf.set("spark.checkpoint.dir", local_dir)
    spark.sparkContext.setCheckpointDir(local_dir)
    return local_dir


def qualified_uri(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the cluster's default file system, in the form Arrow file systems take."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - Hadoop FS has no Python API
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    uri = fs.makeQualified(hpath).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri


_SCRATCH: list[str] = []
_RECORDS: ContextVar[tuple[list[str], ...]] = ContextVar("scanpress_scratch_records", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, removed by :func:`cleanup_scratch`."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base}/scanpress/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    for record in _RECORDS.get():
        record.append(path)
    return path


@contextmanager
def scratch_released(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Gives ``release(*kept)``: it deletes the scratch folders made inside so far that no frame of ``kept`` reads."""
    own: list[str] = []

    def release(*kept: DataFrame) -> None:
        read = {part for df in kept for file in df.inputFiles() for part in file.split("/")}
        for path in [p for p in own if os.path.basename(p) not in read]:
            _delete(spark, path)
            own.remove(path)
            if path in _SCRATCH:
                _SCRATCH.remove(path)

    token = _RECORDS.set((*_RECORDS.get(), own))
    try:
        yield release
    finally:
        _RECORDS.reset(token)


def _delete(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - Hadoop FS has no Python API
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return bool(fs.delete(hpath, True))


def cleanup_scratch(spark: SparkSession | None = None) -> int:
    """Delete the scratch folders this process created (after their results are consumed).

    Uses the Hadoop file system of each path, so it works on shared and
    object stores alike; without a live session only local paths are removed.
    Returns the number of folders removed.
    """
    removed = 0
    while _SCRATCH:
        path = _SCRATCH.pop()
        if spark is not None:
            removed += int(_delete(spark, path))
        else:
            local = path.removeprefix("file:")
            if local.startswith("/") and os.path.isdir(local):
                shutil.rmtree(local, ignore_errors=True)
                removed += 1
    return removed


atexit.register(cleanup_scratch)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``scanpress`` importable in Python workers (``addPyFile`` of a zip, once per application).

    The zip is written to the shared checkpoint folder, not a machine-local
    one, so an executor that replaces a lost one can still fetch it.  It is
    kept for the life of the application (not scratch).
    """
    import io
    import zipfile

    app_id = spark.sparkContext.applicationId
    if app_id in _SHIPPED:
        return
    package_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package_dir)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(package_dir):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    target = f"{ensure_checkpoint_dir(spark)}/scanpress/pyfiles-{app_id}-{uuid.uuid4().hex[:8]}/scanpress.zip"
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS has no Python API
    hpath = jvm.org.apache.hadoop.fs.Path(target)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    stream = fs.create(hpath, True)
    try:
        stream.write(bytearray(buffer.getvalue()))
    finally:
        stream.close()
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app_id)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a frame whose scan yields fewer partitions than the cluster has cores.

    A table stored as one large row group (or one unsplittable file) is read
    by a single task; CPU-heavy per-row work after it would then run on one
    core.  Inputs that already have enough splits - the normal case for big
    tables - are returned untouched, so no shuffle is added at scale.
    Planning the scan to count its partitions runs no job.

    A split without the start of a row group reads nothing, so the row groups
    of few large files count too: their rows go to as many partitions as the
    scan has splits.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits >= target and _row_groups(df.inputFiles(), 2 * target) >= 2 * target:
        return df
    return df.repartition(max(splits, target))


def _row_groups(files: list[str], enough: int) -> int:
    """Row groups of the Parquet files, by their footers; ``enough`` if the files are that many or Arrow cannot open them."""
    from pyarrow import ArrowException
    from pyarrow import fs as pafs
    from pyarrow import parquet as pq

    if len(files) >= enough:
        return enough
    groups = 0
    for uri in files:
        try:
            filesystem, path = pafs.FileSystem.from_uri(uri)
            groups += pq.read_metadata(path, filesystem=filesystem).num_row_groups
        except (ArrowException, OSError):
            return enough
    return groups
