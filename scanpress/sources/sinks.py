"""Sinks (SNK-1, SNK-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanpress.schemas import CORPUS
from scanpress.session import qualified_uri


def write_corpus(corpus: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    """SNK-1: the article table as Parquet, typed as declared (``page`` is a 32-bit int).

    Many part files are written, one per task; ``partition_by="issue"``
    lets later readers prune by issue.
    """
    typed = corpus.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CORPUS.fields])
    writer = typed.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_article_docs(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-2: one HTML document per article, stored as ``(file_name, html)`` rows in Parquet.

    Writing one file per article from the driver would not scale; the table
    keeps the unique names and UTF-8 text, and readers work from it.
    """
    docs.select("file_name", "html").write.mode(mode).parquet(path)


WRITTEN = "file_name string, path string, bytes long"


def write_files(
    docs: DataFrame, folder: str, name: str = "file_name", content: str = "html", subdir: str | None = None
) -> DataFrame:
    """SNK-2 as files: every row becomes one file ``<folder>[/<subdir>]/<name>``, written by the tasks.

    Each task writes its own rows through ``pyarrow.fs`` (local paths, shared
    mounts, HDFS or object stores); nothing passes through the driver.  A
    retried task rewrites the same names with the same bytes.  Returns a
    lazy frame of ``(file_name, path, bytes)``; run an action on it to write.
    A folder without a scheme is on the session's default file system, as for
    Spark's own writers; null content writes an empty file.
    """
    uri = qualified_uri(docs.sparkSession, folder)
    cols = [F.col(name).alias("_name"), F.col(content).alias("_content")]
    if subdir is not None:
        cols.append(F.col(subdir).cast("string").alias("_subdir"))
    rows = docs.select(*cols)
    has_subdir = subdir is not None

    def write(batches):  # noqa: ANN001, ANN202
        import pandas as pd
        from pyarrow import fs as pafs

        filesystem, root = pafs.FileSystem.from_uri(uri)
        made: set[str] = set()
        for pdf in batches:
            out = []
            for rec in pdf.itertuples(index=False):
                parent = f"{root}/{rec._2}" if has_subdir else root
                if parent not in made:
                    filesystem.create_dir(parent, recursive=True)
                    made.add(parent)
                text = "" if rec._1 is None else rec._1
                data = text if isinstance(text, (bytes, bytearray)) else str(text).encode("utf-8")
                path = f"{parent}/{rec._0}"
                with filesystem.open_output_stream(path, compression=None) as stream:
                    stream.write(data)
                out.append((rec._0, path, len(data)))
            yield pd.DataFrame(out, columns=["file_name", "path", "bytes"])

    return rows.mapInPandas(write, WRITTEN)
