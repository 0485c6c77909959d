"""Tables that grow by whole commits (used by run outputs, the reply ledger and the streams).

An append first writes its rows as Parquet under a name of its own, then puts an empty file, named after the append's
key and that folder, into ``_commits``.  Readers see only folders that a commit names: what a failed or aborted append
left behind stays invisible, and a second run adds to the first.  A key is committed once: appending under a known key
again (a replayed batch) changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from scanpress.session import qualified_uri


class CommitTable:
    """The committed appends below ``root``, on any file system Spark reaches."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001 - Hadoop FS has no Python API
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001

    def commits(self) -> dict[str, str]:
        """key -> folder of its rows; the driver lists one empty file per commit."""
        folder = self._path(f"{self.root}/_commits")
        if not self._fs.exists(folder):
            return {}
        names = sorted(status.getPath().getName() for status in self._fs.listStatus(folder))
        found: dict[str, str] = {}
        for name in names:
            key, data = name.split("@", 1)
            found.setdefault(unquote(key), f"{self.root}/{data}")
        return found

    def append(self, rows: DataFrame, key: str | None = None) -> bool:
        """Add the rows as one commit; False, and nothing written, if the key is committed already."""
        key = uuid.uuid4().hex if key is None else key
        if key in self.commits():
            return False
        data = f"data-{uuid.uuid4().hex}"
        typed = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields])
        typed.write.parquet(f"{self.root}/{data}")
        self.publish(key, data)
        return True

    def write_parts(self, rows: DataFrame, folder_of: Callable[[int], str]) -> DataFrame:
        """A lazy frame that writes each partition's rows as one file into the folder its number is given, and tells the file.

        Nothing is visible before :meth:`publish`.  A repeated task replaces its file as a whole.
        """
        uri = qualified_uri(self.spark, self.root)
        typed = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields])

        def write(batches):  # noqa: ANN001, ANN202
            import pyarrow as pa
            from pyarrow import fs as pafs
            from pyarrow import parquet as pq
            from pyspark import TaskContext

            held = [batch for batch in batches if batch.num_rows]
            if not held:
                return
            task = TaskContext.get()
            number = task.partitionId()
            filesystem, root = pafs.FileSystem.from_uri(uri)
            folder = f"{root}/{folder_of(number)}"
            filesystem.create_dir(folder, recursive=True)
            # Readers pass over the name in progress.
            part, begun = f"{folder}/part-{number:06d}.parquet", f"{folder}/_part-{number:06d}-{task.taskAttemptId()}"
            pq.write_table(pa.Table.from_batches(held), begun, filesystem=filesystem)
            filesystem.move(begun, part)
            yield pa.RecordBatch.from_pydict({"file": [part]})

        return typed.mapInArrow(write, "file string")

    def publish(self, key: str, data: str) -> None:
        """Make the folder ``data`` visible under the key."""
        self._fs.mkdirs(self._path(f"{self.root}/_commits"))
        self._fs.create(self._path(f"{self.root}/_commits/{quote(key, safe='')}@{data}"), False).close()

    def read(self, keys: list[str] | None = None) -> DataFrame:
        """All committed rows, or those of some keys."""
        found = self.commits()
        folders = [found[k] for k in (found if keys is None else keys)]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def drop(self, keys: list[str]) -> None:
        """Withdraw commits, then delete their rows."""
        found = self.commits()
        for key in keys:
            data = found[key].rsplit("/", 1)[1]
            self._fs.delete(self._path(f"{self.root}/_commits/{quote(key, safe='')}@{data}"), False)
            self._fs.delete(self._path(found[key]), True)
