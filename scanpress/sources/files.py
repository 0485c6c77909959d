"""File sources (SRC-1, SRC-2, SRC-3, SRC-4).

Scans and names are listed and read by Spark's file sources; only the columns a
caller selects are read (selecting ``path`` alone never loads ``content``).
Spark passes over names it takes for hidden (``_x``, ``.x``); those files are
listed and read by the tasks of :func:`hidden_files`, so every file is seen once.

Article files are far more than scans, and Spark's sources hold every file they
read in the driver; so tasks list them all into a table and read them by it.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from datetime import datetime, timezone
from fnmatch import fnmatchcase
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanpress.functions.names import base_name, file_stem
from scanpress.operators.ranking import materialize
from scanpress.schemas import RESPONSES

READ_AT_ONCE = 4 << 20
LISTED = "uri string, is_dir boolean, hidden boolean, length long, mtime timestamp"


def spark_hides(name: str, folder: bool) -> bool:
    """Whether Spark's file sources pass over a file or folder of this name."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _arrow_uri(uri: str) -> str:
    """The uri under the scheme by which Arrow knows its store."""
    scheme, mark, rest = uri.partition("://")
    return "s3" + mark + rest if scheme in ("s3a", "s3n") else uri


def arrow_opens(uri: str) -> bool:
    from pyarrow import ArrowException
    from pyarrow import fs as pafs

    try:
        pafs.FileSystem.from_uri(_arrow_uri(quote(uri, safe="/:@%")))
    except (ArrowException, OSError):
        return False
    return True


def _hadoop_hidden(jvm, fs, root, recursive: bool) -> list[tuple]:  # noqa: ANN001
    """The files below ``root`` that Spark passes over, listed by Hadoop: for stores that Arrow cannot open.

    The folders are listed and matched in the JVM, a glob per level; only hidden files come to Python.
    """
    found = {}

    def add(status) -> None:  # noqa: ANN001
        uri = status.getPath().toUri().toString()  # escaped
        found[uri] = (uri, False, True, status.getLen(), datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc))

    level = re.sub(r"([*?\[\]{}\\])", r"\\\1", root.toString())
    while True:
        for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(level + "/{.*,_*,*._COPYING_}")) or []:
            name, folder = status.getPath().getName(), status.isDirectory()
            if not spark_hides(name, folder):
                continue
            if not folder:
                add(status)
            elif recursive:
                below = fs.listFiles(status.getPath(), True)
                while below.hasNext():
                    add(below.next())
        level += "/*"
        if not recursive or not fs.globStatus(jvm.org.apache.hadoop.fs.Path(level + "/*")):
            return list(found.values())


def _roots(spark: SparkSession, folders: tuple[str, ...], recursive: bool) -> list[tuple]:
    """The folders that the given paths or globs name, as rows of ``LISTED``; where Arrow has no file system, their hidden files."""
    rows = []
    for folder in folders:
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001 - Hadoop FS has no Python API
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
        for status in fs.globStatus(hpath) or []:
            if status.isDirectory():
                uri = status.getPath().toString()
                uri = "file://" + uri.removeprefix("file:") if uri.startswith("file:/") else uri
                uri = quote(uri, safe="/:@")
                if arrow_opens(uri):
                    rows.append((uri, True, False, None, None))
                else:
                    rows += _hadoop_hidden(spark.sparkContext._jvm, fs, status.getPath(), recursive)  # noqa: SLF001
    return rows


def _expanded(rows: DataFrame, glob: str, recursive: bool) -> DataFrame:
    """Every folder of ``rows`` replaced by what it holds: its sub-folders, and the files Spark passes over."""

    def expand(batches):  # noqa: ANN001, ANN202
        import pandas as pd
        from pyarrow import fs as pafs

        names = ["uri", "is_dir", "hidden", "length", "mtime"]
        for pdf in batches:
            out = pdf[~pdf.is_dir].to_dict("records")
            for rec in pdf[pdf.is_dir].itertuples(index=False):
                filesystem, root = pafs.FileSystem.from_uri(_arrow_uri(rec.uri))
                root = root.rstrip("/")
                for info in filesystem.get_file_info(pafs.FileSelector(root, recursive=recursive)):
                    inner = info.path[len(root):].strip("/")
                    is_dir = info.type == pafs.FileType.Directory
                    *above, last = inner.split("/")
                    hidden = bool(rec.hidden) or spark_hides(last, is_dir) or any(spark_hides(n, True) for n in above)
                    if is_dir and not recursive or not is_dir and hidden and fnmatchcase(info.base_name, glob):
                        uri = f"{rec.uri.rstrip('/')}/{quote(inner)}"
                        out.append(dict(zip(names, (uri, is_dir, hidden, info.size, info.mtime))))
            frame = pd.DataFrame(out, columns=names)
            frame["length"] = frame["length"].astype("Int64")
            frame["mtime"] = pd.to_datetime(frame["mtime"], utc=True)
            yield frame

    return rows.mapInPandas(expand, LISTED)


def _matches(uri: str, glob: str) -> Column:
    """Whether the last part of the uri matches a glob of stars and literals."""
    return F.url_decode(base_name(uri)).rlike("^" + ".*".join(re.escape(part) for part in glob.split("*")) + "$")


def hidden_files(spark: SparkSession, *folders: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """Files below the folders that Spark's sources pass over, as ``(uri, length, mtime)``.

    Listed by the tasks through ``pyarrow.fs``: first the given folders, then
    each sub-folder with all it holds, dealt out by name.  Nothing but the
    given folders passes through the driver.  Not recursive: only files
    directly in the folders.  A store that Arrow cannot open is listed by
    Hadoop in the driver, hidden files only; their content cannot be read, so
    a reader of content fails there if, and only if, it finds any.
    """
    roots = _roots(spark, folders, recursive)
    rows = spark.createDataFrame(roots, LISTED).repartition(max(len(roots), 1))
    rows = rows.filter(F.col("is_dir") | _matches("uri", glob))
    rows = _expanded(rows, glob, recursive=False)
    if recursive:
        rows = rows.repartition(spark.sparkContext.defaultParallelism, "uri")
        rows = _expanded(rows, glob, recursive=True)
    return rows.filter(~F.col("is_dir")).select("uri", "length", "mtime")


def _with_content(files: DataFrame) -> DataFrame:
    """The listed files with their bytes, one file in memory at a time."""

    def read(batches):  # noqa: ANN001, ANN202
        from pyarrow import fs as pafs

        for pdf in batches:
            for i in range(len(pdf)):
                one = pdf.iloc[i : i + 1]
                filesystem, path = pafs.FileSystem.from_uri(_arrow_uri(one["uri"].iloc[0]))
                with filesystem.open_input_stream(path, compression=None) as stream:
                    yield one.assign(content=[stream.read()])

    return files.mapInPandas(read, "uri string, length long, mtime timestamp, content binary")


def _encoded(uri: str) -> Column:
    """A listed uri in the form of ``_metadata.file_path``."""
    return F.regexp_replace(uri, "^file:///", "file:/")


def _decoded(uri: str) -> Column:
    """A listed uri as the ``path`` of Spark's binary source (a ``+`` in a name is escaped in the uri)."""
    return F.url_decode(_encoded(uri))


SPLITS_A_TASK = 16


def _few_tasks(files: DataFrame) -> DataFrame:
    """Several splits of many small files read by one task.

    Spark takes a file for as dear to open as 4 MB are to read, so a split holds some 32 small files, and a task that
    starts Python workers for them takes longer to start than to read.  Nothing moves.
    """
    splits, least = files.rdd.getNumPartitions(), 4 * files.sparkSession.sparkContext.defaultParallelism
    return files if splits <= least else files.coalesce(max(least, splits // SPLITS_A_TASK))


FOUND = "folder string, name string, length long"  # a folder still to be listed has no name
LISTED_AT_ONCE = 10_000
FILE_COST = 16 << 10
LEAST_FILES = 32


def _entries(filesystem, folder: str) -> Iterator[tuple[str, bool, int | None]]:  # noqa: ANN001
    """(name, whether a folder, bytes) of all that lies directly in a folder; a local folder is never held as a whole."""
    from pyarrow import fs as pafs

    if filesystem.type_name != "local":
        for info in filesystem.get_file_info(pafs.FileSelector(folder)):
            yield info.base_name, info.type == pafs.FileType.Directory, info.size
        return
    with os.scandir(folder or "/") as entries:
        for entry in entries:
            try:
                is_dir = entry.is_dir()
                yield entry.name, is_dir, None if is_dir else entry.stat().st_size
            except FileNotFoundError:  # gone since, or a link to nothing: Hadoop's listing has no such file
                continue


def _found(rows: DataFrame, ending: str, recursive: bool) -> DataFrame:
    """Every folder of ``rows`` replaced by the files in it whose names have the ending, and by its sub-folders or all their files."""

    def walked(folder: str) -> Iterator[tuple]:
        from pyarrow import fs as pafs

        todo = [folder]
        while todo:
            uri = todo.pop()
            filesystem, root = pafs.FileSystem.from_uri(_arrow_uri(uri))
            for name, is_dir, length in _entries(filesystem, root.rstrip("/")):
                if not is_dir:
                    if name.endswith(ending):
                        yield uri, name, length
                elif recursive:
                    todo.append(f"{uri.rstrip('/')}/{quote(name)}")
                else:
                    yield f"{uri.rstrip('/')}/{quote(name)}", None, None

    def find(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        schema = pa.schema([("folder", pa.string()), ("name", pa.string()), ("length", pa.int64())])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            out = []
            for folder, name, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for row in walked(folder) if name is None else [(folder, name, length)]:
                    out.append(row)
                    if len(out) == LISTED_AT_ONCE:
                        yield batch_of(out)
                        out = []
            if out:
                yield batch_of(out)

    return rows.mapInArrow(find, FOUND)


def _hadoop_escaped(name: str) -> str:
    """A name as it stands in Hadoop's uris and ``_metadata.file_path``."""
    if re.fullmatch(r"[\w.~!*'();:@&=+$,-]*", name, re.ASCII):
        return name
    odd = [c in '"#%<>?[\\]^`{|}' or unicodedata.category(c) in ("Cc", "Zs", "Zl", "Zp") for c in name]
    return "".join(quote(c) if o else c for c, o in zip(name, odd, strict=True))


def _read_found(files: DataFrame) -> DataFrame:
    """(file_name, path, html) of listed files, read by the tasks, a few megabytes or one file in memory at a time.

    The rows of the listing are dealt to as many tasks as the files' bytes take at ``spark.sql.files.maxPartitionBytes``,
    where a file counts as ``FILE_COST`` bytes more than it has; few files to 4 tasks a core, of ``LEAST_FILES`` files at least.
    """

    def read(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa
        from pyarrow import fs as pafs

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["file_name", "path", "content"])

        last = None
        for batch in batches:
            held, size = [], 0
            for folder, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if folder != last:
                    filesystem, root = pafs.FileSystem.from_uri(_arrow_uri(folder))
                    above = unquote(re.sub("^file:///", "file:/", folder)).rstrip("/")
                    last, above = folder, "/".join(_hadoop_escaped(part) for part in above.split("/"))
                with filesystem.open_input_stream(f"{root.rstrip('/')}/{name}", compression=None) as stream:
                    held.append((name, f"{above}/{_hadoop_escaped(name)}", stream.read()))
                size += len(held[-1][2])
                if size >= READ_AT_ONCE:
                    yield batch_of(held)
                    held, size = [], 0
            if held:
                yield batch_of(held)

    spark = files.sparkSession
    count, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())  # noqa: SLF001 - a size as a string has no Python reader
    tasks = max(-(-(size + count * FILE_COST) // split), min(count // LEAST_FILES, 4 * spark.sparkContext.defaultParallelism), 1)
    dealt = files.select("folder", "name").repartition(tasks).sortWithinPartitions("folder", "name")
    return dealt.mapInArrow(read, "file_name string, path string, content binary").select(
        "file_name", "path", F.col("content").cast("string").alias("html")
    )


def _read_by_spark(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`read_article_html` by Spark's text source, which lists in the driver: for stores that Arrow cannot open.

    ``wholetext`` must be the ``text()`` keyword: as an option the keyword's
    default overrides it and the file comes back line by line.
    """
    df = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.html")
    hidden = _with_content(hidden_files(spark, folder, glob="*.html"))
    return _few_tasks(df).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("html"),
    ).unionByName(
        hidden.select(
            base_name(_decoded("uri")).alias("file_name"),
            _encoded("uri").alias("path"),
            F.col("content").cast("string").alias("html"),
        )
    )


def read_article_html(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-1: every ``*.html`` file below ``folder`` as one row ``(file_name, path, html)``.

    Listed at the call, as by Spark's sources, but by the tasks and into a table: first the given folders, then each
    sub-folder with all it holds, dealt out by name.  Neither names nor splits of files pass through the driver.
    """
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001 - Hadoop FS has no Python API
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    roots = []
    for status in fs.globStatus(hpath) or []:
        uri = _as_uri(status.getPath().toString())
        if status.isDirectory():
            roots.append((uri, None, None))
        elif status.getPath().getName().endswith(".html"):
            roots.append((_as_uri(status.getPath().getParent().toString()), status.getPath().getName(), status.getLen()))
        if not arrow_opens(uri):
            return _read_by_spark(spark, folder)
    if not roots:  # Spark says what is missing, or reads nothing
        return _read_by_spark(spark, folder)
    cores = spark.sparkContext.defaultParallelism
    rows = _found(spark.createDataFrame(roots, FOUND).repartition(min(len(roots), 4 * cores)), ".html", recursive=False)
    rows = rows.repartition(cores, "folder", "name")
    return _read_found(materialize(_found(rows, ".html", recursive=True), "article-listing"))


def compact_article_html(spark: SparkSession, folder: str, out: str, target_files: int | None = None) -> None:
    """Read a folder of many small article files once and store them as a ``(file_name, path, html)`` table.

    Listing millions of small files is the cost of SRC-1; after one
    compaction every later job reads a few large Parquet files instead.
    ``target_files`` merges the read splits without a shuffle.
    """
    df = read_article_html(spark, folder)
    if target_files:
        df = df.coalesce(target_files)
    df.write.mode("overwrite").parquet(out)


def read_scans(spark: SparkSession, *folders: str, with_content: bool = True) -> DataFrame:
    """SRC-2: scan files directly in the given folders (not recursive)."""
    df = spark.read.format("binaryFile").load(list(folders))
    hidden = hidden_files(spark, *folders, recursive=False)
    hidden = _with_content(hidden) if with_content else hidden.withColumn("content", F.lit(None).cast("binary"))
    cols = [
        F.col("path"),
        file_stem(base_name("path")).alias("stem"),
        F.col("length"),
        F.col("modificationTime").alias("mtime"),
    ]
    if with_content:
        cols.append(F.col("content"))
    hidden = hidden.withColumnsRenamed({"mtime": "modificationTime"}).withColumn("path", _decoded("uri"))
    return df.select(*cols).unionByName(hidden.select(*cols))


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, content) of a bounded list of files by the paths a listing gave; files gone since are left out."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001 - Hadoop FS has no Python API
    there = [jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    paths = [p for p, h in zip(paths, there, strict=True) if h.getFileSystem(conf).exists(h)]
    shown = [p for p in paths if not spark_hides(p.rsplit("/", 1)[1], False)]
    hidden = [(_as_uri(p), None, None) for p in paths if spark_hides(p.rsplit("/", 1)[1], False)]
    frames = []
    if shown:
        literal = ["".join("\\" + c if c in "*?[]{}\\" else c for c in p) for p in shown]  # names are no globs
        frames.append(spark.read.format("binaryFile").option("ignoreMissingFiles", "true").load(literal).select("path", "content"))
    if hidden:
        listed = spark.createDataFrame(hidden, "uri string, length long, mtime timestamp").repartition(len(hidden))
        frames.append(_with_content(listed).select(_decoded("uri").alias("path"), "content"))
    if not frames:
        return spark.createDataFrame([], "path string, content binary")
    return reduce(DataFrame.unionByName, frames)


def read_listed(listed: DataFrame) -> DataFrame:
    """(path, content) of the files named by ``path`` as a listing gave it, read by the tasks through ``pyarrow.fs``, a few
    megabytes or one file in memory at a time; files gone since are left out.  Partitions stay as they are."""

    def read(batches):  # noqa: ANN001, ANN202
        import pandas as pd
        from pyarrow import fs as pafs

        for pdf in batches:
            held, size = [], 0
            for name in pdf["path"]:
                filesystem, path = pafs.FileSystem.from_uri(_arrow_uri(_as_uri(name)))
                try:
                    with filesystem.open_input_stream(path, compression=None) as stream:
                        held.append((name, stream.read()))
                except FileNotFoundError:
                    continue
                size += len(held[-1][1])
                if size >= READ_AT_ONCE:
                    yield pd.DataFrame(held, columns=["path", "content"])
                    held, size = [], 0
            if held:
                yield pd.DataFrame(held, columns=["path", "content"])

    return listed.select("path").mapInPandas(read, "path string, content binary")


def _as_uri(path: str) -> str:
    return quote("file://" + path.removeprefix("file:") if path.startswith("file:/") else path, safe="/:@")


def list_article_names(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-3: the name of every file below ``folder``, any extension; names only."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    hidden = hidden_files(spark, folder).select(_decoded("uri").alias("path"))
    return df.select("path").unionByName(hidden).select(base_name("path").alias("file_name"))


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC-4: reply records with the declared schema (``parquet`` or ``json``)."""
    reader = spark.read.schema(RESPONSES)
    return reader.json(path) if fmt == "json" else reader.parquet(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """The corpus table with its declared types.

    A corpus written with ``partition_by="issue"`` keeps ``issue`` a string
    (partition inference would make ``1001`` a number), and a filter on it
    prunes whole partition folders.
    """
    from scanpress.schemas import CORPUS

    return spark.read.schema(CORPUS).parquet(path)
